"""HTML extraction: page structure first, then a suffix array of each host over what structure leaves open."""

import html
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from ..session import settle
from .common import bare, flushed, rows_of, settle_text

#: Words of a repeated substring, at least; shorter blocks count as one substring.
DEPTH = 6
#: Words from which a repeat inside a block is boilerplate; a shorter one must stand at the block's beginning or end.
LONG = 16
#: Share of a host's distinct pages, and least number of them, that must share a repeat: of open blocks, and of prose, an article's own blocks.
OPEN_PAGES, PROSE_PAGES = (0.25, 2), (0.5, 5)

#: HTML's element classes.
RAW = {"script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes", "noscript"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption",
         "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre",
         "section", "summary", "table", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
PROSE = HEADING | {"p", "pre", "blockquote", "li", "dd", "dt", "td", "th", "figcaption", "caption", "summary", "article", "main"}
#: What never belongs to the main text: by element, role, and whole words of class or id.
DROPPED = {"nav", "footer", "aside", "head", "template", "svg", "canvas", "object", "video", "audio", "button", "select", "datalist", "dialog", "menu"}
DROPPED_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu", "menubar", "toolbar"}
DROPPED_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "sidebar", "nav", "navbar",
                 "navigation", "menu", "breadcrumb", "breadcrumbs", "footer", "header", "masthead", "banner", "cookie", "cookies", "consent", "gdpr",
                 "notice", "notices", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "paywall", "comment",
                 "comments", "reply", "replies", "disqus", "share", "sharing", "social", "related", "recommended", "widget", "pagination", "pager",
                 "toolbar"}
#: Those that say little inside an article, where they stand on its own parts too.
UNSURE_WORDS = {"header", "masthead", "banner", "promo", "promotion", "notice", "notices", "alert", "overlay", "widget", "social", "share", "sharing",
                "related", "recommended", "reply", "replies", "menu", "subscription"}
#: Words that, as a part of a class or id ("reader-comments", "ad-slot", "comment12"), tell of a block inside an article that is none of its text.
FOREIGN_PARTS = {"comment", "comments", "disqus", "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "newsletter",
                 "subscribe", "signup", "paywall", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "sidebar", "popup", "modal", "breadcrumb",
                 "breadcrumbs", "pagination", "pager"}
#: Beginnings of classes that say how a block is laid out or what it lacks ("with-sidebar", "no-comments").
LAYOUT = ("no-", "no_", "non-", "with-", "without-", "has-", "is-")
#: How sure it is that an element is no part of a main text; a SOFT one may still be a wrapper round the article, a FOREIGN one inside the article
#: a wrapper round all of its text.
UNSURE, FOREIGN, SOFT, HARD = 1, 2, 3, 4

_TAG = re.compile(r"""<([A-Za-z][^\s/>]*+)((?:[\s/]++|[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+))?+|=)*+)>""")
_END = re.compile(r"</([A-Za-z][^\s/>]*+)[^>]*+>")
_ATTRIBUTE = re.compile(r"""([^\s/>=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"'][^\s>]*+)))?+""")
_WORD = re.compile(r"[a-z]+")


def events(page):
    """("text", data), ("start", name, attributes) and ("end", name) in page order; comments, raw text elements and cut-off tags are skipped."""
    at, size = 0, len(page)
    while at < size:
        open_at = page.find("<", at)
        if open_at < 0:
            yield "text", page[at:], None
            return
        if open_at > at:
            yield "text", page[at:open_at], None
        following = page[open_at + 1:open_at + 2]
        if following.isascii() and following.isalpha():
            m = _TAG.match(page, open_at)
            if not m:
                return
            name, at = m.group(1).lower(), m.end()
            yield "start", name, m.group(2)
            if name in RAW:
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
                if not close:
                    return
                at = close.start()
        elif following == "/":
            m = _END.match(page, open_at)
            end = page.find(">", open_at)
            if end < 0:
                return
            if m:
                yield "end", m.group(1).lower(), None
            at = end + 1
        elif following in ("!", "?"):
            comment = page.startswith("<!--", open_at)
            end = page.find("-->" if comment else ">", open_at + (4 if comment else 2))
            if end < 0:
                return
            at = end + (3 if comment else 1)
        else:
            yield "text", "<", None
            at = open_at + 1


def _dropped(name, attributes, inside, in_article):
    """How sure it is that the element is no part of a main text, 0 if nothing says so."""
    if name in DROPPED or name in RAW or name == "header" and not inside:
        return HARD
    least = SOFT if name == "form" else 0
    if not attributes or attributes.isspace() or name in HEADING or name in ("html", "body", "main"):
        return least
    values = {m.group(1).lower(): next((g for g in m.groups()[1:] if g is not None), "") for m in _ATTRIBUTE.finditer(attributes)}
    if "hidden" in values or values.get("aria-hidden", "").lower() == "true" or "display:none" in values.get("style", "").replace(" ", "").lower():
        return HARD
    role = values.get("role", "").lower()
    if role in DROPPED_ROLES:
        return HARD
    tokens = set(f"{values.get('class', '')} {values.get('id', '')}".lower().split())
    if name == "article":
        return HARD if tokens & {"comment", "comments", "reply", "replies"} else least
    if role == "form" or tokens & (DROPPED_WORDS - UNSURE_WORDS if in_article else DROPPED_WORDS):
        return SOFT
    if in_article and name in BLOCK and any(w in FOREIGN_PARTS for t in tokens if not t.startswith(LAYOUT) for w in _WORD.findall(t)):
        return max(least, FOREIGN)
    return max(least, UNSURE if any(w in DROPPED_WORDS for t in tokens for w in _WORD.findall(t)) else 0)


def blocks(page):
    """(text, open) of the visible blocks of a page's main region, in order.

    The region is every article, else the main element, else the whole page. An article or main element inside a wrapper that its class,
    its id or a form speaks against is the region if there is none outside, and what a form holds if there is nothing else. ``open``
    marks blocks that structure leaves undecided: outside any article, or inside one but in no element for prose or in one
    whose class or id speaks against it.
    """
    out, held = [], []  # (text, region, open, foreign)
    stack = []  # (name, region, dropped)
    region, dropped = "", 0

    def close():
        if held:
            text = " ".join("".join(held).split())
            held.clear()
            if text:
                container = next((n for n, *_ in reversed(stack) if n in BLOCK), "body")
                out.append((text, region, not region or container not in PROSE or dropped in (UNSURE, FOREIGN), dropped == FOREIGN))

    def hidden():
        return dropped == HARD or dropped == SOFT and region != "form"

    for kind, data, attributes in events(page):
        if kind == "text":
            if not hidden():
                held.append(html.unescape(data))
            continue
        if data == "br" or data in VOID and data != "hr":
            if not hidden() and data == "br":
                held.append(" ")
            continue
        if kind == "start":
            if data in BLOCK:
                close()
                for i in range(len(stack) - 1, -1, -1):  # a block ends the paragraph it stands in
                    if stack[i][0] == "p" or stack[i][0] in HEADING and data in HEADING:
                        del stack[i:]
                        break
                    if stack[i][0] in BLOCK:
                        break
                region, dropped = stack[-1][1:] if stack else ("", 0)
            if data == "hr":
                continue
            inside = region in ("article", "main", "wrapped article", "wrapped main")
            dropped = max(dropped, _dropped(data, attributes, inside, region.endswith("article")))
            if data in ("article", "main") and dropped != HARD:
                if dropped < SOFT and not region.endswith("article"):
                    region = f"wrapped {data}" if region.startswith("wrapped") else data
                elif dropped == SOFT:
                    region = f"wrapped {data}"
                if dropped != FOREIGN:  # an article inside a foreign block is a comment, say
                    dropped = 0
            elif data == "form" and dropped == SOFT and not region and not any(d >= SOFT for *_, d in stack):
                region = "form"
            stack.append((data, region, dropped))
        else:
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == data), None)
            if data in BLOCK:
                close()
            if at is not None:
                if any(n in BLOCK for n, *_ in stack[at:]):
                    close()
                del stack[at:]
                region, dropped = stack[-1][1:] if stack else ("", 0)
    close()
    seen = {r for _, r, *_ in out}
    wanted = next((r for r in ("article", "main", "wrapped article", "wrapped main", "", "form") if r in seen), "")
    own = [(t, o or wanted in ("", "form"), f) for t, r, o, f in out if r == wanted]
    whole = all(f for *_, f in own)  # a foreign block that holds all of the text is a wrapper
    return [(t, o) for t, o, f in own if whole or not f]


def host_of(url):
    """Lower-case host of a URL column, empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"://([^/?#]*)", 1)), F.lit(""))


def _parsed(pages):
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("content", pa.binary()),
                        ("blocks", pa.list_(pa.struct([("text", pa.string()), ("open", pa.bool_())])))])

    def run(batches):
        for batch in batches:
            yield from flushed(((i, url, host, xxhash.xxh3_128_digest((page or "").encode("utf-8", "surrogatepass")),
                                 [dict(text=t, open=o) for t, o in blocks(page or "")])
                                for i, url, host, page in rows_of(batch, "page_id", "url", "host", "html")), schema, 200)

    return pages.mapInArrow(run, "page_id bigint, url string, host string, content binary, blocks array<struct<text: string, open: boolean>>")


#: Base of the polynomial hash modulo 2**64, its inverse, and the bytes of text hashed at once; a block is not cut.
_BASE, _STRETCH = 0x9E3779B97F4A7C15, 1 << 20
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {}


def _powers_of(base, size):
    """Powers of ``base`` modulo 2**64, kept and grown as texts ask for it."""
    if len(_powers.get(base, ())) < size:
        factors = np.full(max(size, _STRETCH), base, np.uint64)
        factors[0] = 1
        _powers[base] = np.cumprod(factors, dtype=np.uint64)
    return _powers[base][:size]


def _hashed(data, starts, ends):
    """Hashes of the bytes from each start up to each end, from one running polynomial."""
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * _powers_of(_BASE, len(data)), out=running[1:])
    return (running[ends] - running[starts]) * _powers_of(_INVERSE, len(data) + 1)[starts]


def _mixed(keys):
    keys = (keys ^ (keys >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return keys ^ (keys >> np.uint64(29))


def _anchors(data, bounds, is_open, salt, depth):
    """(block, key) of the beginnings by which blocks may be found to share a stretch: all of an open block, of prose those that winnowing picks.

    ``data`` holds the blocks' bytes, block n from ``bounds[n]`` on, words parted by one space. Of any LONG - depth + 1 neighbouring
    beginnings the least key is picked, and the least of each block, so stretches of LONG words that are equal have an anchor in common, and equal blocks
    too. A key's last bit tells prose. Keys that are equal by chance let a block in for nothing.
    """
    spaces = np.flatnonzero(data == 32)
    starts = np.sort(np.concatenate([bounds[:-1], spaces + 1]))
    ends = np.sort(np.concatenate([bounds[1:], spaces]))
    first = np.searchsorted(starts, bounds[:-1])
    size = np.diff(np.append(first, len(starts)))
    block = np.repeat(np.arange(len(first)), size)
    place = np.arange(len(starts)) - first[block]
    at = np.flatnonzero(place <= np.maximum(size[block] - depth, 0))
    last = np.minimum(at + depth, first[block[at]] + size[block[at]]) - 1
    block = block[at]
    keys = _mixed(_hashed(data, starts[at], ends[last]) + salt[block])
    picked = is_open[block]
    width = min(LONG - depth + 1, len(keys)) if depth <= LONG else 1
    if len(keys):
        windows = np.lib.stride_tricks.sliding_window_view(keys, width)
        picked[np.arange(len(windows)) + windows.argmin(axis=1)] = True
        firsts = np.flatnonzero(np.diff(block, prepend=-1))
        picked |= keys == np.repeat(np.minimum.reduceat(keys, firsts), np.diff(np.append(firsts, len(keys))))
    keys = (keys & ~np.uint64(1)) | (~is_open[block]).astype(np.uint64)
    return block[picked], keys[picked].view(np.int64)


def _anchored(batch, depth):
    """(page of the batch, block of the page, key) arrays, stretch by stretch of a batch's blocks."""
    pages = batch.column(batch.schema.get_field_index("blocks"))
    counts = np.diff(np.asarray(pages.offsets))
    page = np.repeat(np.arange(len(pages)), counts)
    block = np.arange(len(page)) - np.repeat(np.cumsum(counts) - counts, counts)
    texts, is_open = pages.flatten().flatten()
    texts, is_open = texts.cast(pa.large_string()), np.asarray(is_open.to_pylist(), dtype=bool)
    hosts = batch.column(batch.schema.get_field_index("host")).to_pylist()
    salt = np.array([xxhash.xxh64_intdigest(h.encode("utf-8", "surrogatepass")) for h in hosts], dtype=np.uint64)
    if not len(page):
        return
    _, offsets, content = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(content, np.uint8)
    at = 0
    while at < len(texts):
        past = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _STRETCH, "right")) - 1)
        own, keys = _anchors(data[offsets[at]:offsets[past]], offsets[at:past + 1] - offsets[at], is_open[at:past], salt[page[at:past]], depth)
        yield page[at:past][own], block[at:past][own], keys
        at = past


def _digest(text):
    return xxhash.xxh3_128_digest(text.encode("utf-8", "surrogatepass"))


def _suffixes(text, is_open, depth):
    """(place, suffix) of a block, cut where a comparison may end: at ``depth`` words if it is open, else at LONG; a shorter block is one suffix."""
    words = text.split()
    most = depth if is_open else max(LONG, depth)
    if len(words) < most and not is_open:
        return [(-1, "\n" + " ".join(words))]
    return [(i, " ".join(words[i:i + most])) for i in range(max(1, len(words) - most + 1))]


def _live(parsed, sizes, depth):
    """``host, content, live``: the blocks that share an anchor, an open one with another page, prose with many pages of its host.

    Keys are counted without their pages, in one shuffle of narrow rows after a partial count; copies of a page count
    here, which only lets more blocks in. The few keys that are shared meet the anchors once more, made anew.
    """
    def count(batches):
        for batch in batches:
            for page, _, keys in _anchored(batch, depth):
                order = np.lexsort((page, keys))
                page, keys = page[order], keys[order]
                new = np.ones(len(keys), bool)
                new[1:] = (np.diff(page) != 0) | (keys[1:] != keys[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(keys[new])], names=["key"])

    def find(batches):
        for batch in batches:
            host, content = (batch.column(batch.schema.get_field_index(n)) for n in ("host", "content"))
            for page, block, keys in _anchored(batch, depth):
                yield pa.RecordBatch.from_arrays([host.take(pa.array(page)), content.take(pa.array(page)), pa.array(block.astype(np.int32)), pa.array(keys)],
                                                 names=["host", "content", "block", "key"])

    own = parsed.select("host", "content", "blocks")
    prose = F.col("key").bitwiseAND(1) == 1
    counts = own.select("host", "blocks").mapInArrow(count, "key bigint").groupBy("key").agg(F.count("*").alias("n"))
    shared = settle(counts.where(F.col("n") >= F.when(prose, PROSE_PAGES[1]).otherwise(OPEN_PAGES[1])), "anchors")
    met = own.mapInArrow(find, "host string, content binary, block int, key bigint").join(shared, "key")
    enough = met.withColumn("prose", prose).join(sizes, "host").where(~F.col("prose") | (F.col("n") >= _enough()))
    return settle(enough.groupBy("host", "content").agg(F.collect_set("block").alias("live")), "live")


def _enough():
    """Least number of distinct pages that must share a repeat, from the host's number of ``pages``."""
    def least(share, pages):
        return F.greatest(F.lit(pages), F.ceil(F.lit(share) * F.col("pages")))

    return F.when(F.col("prose"), least(*PROSE_PAGES)).otherwise(least(*OPEN_PAGES))


def suffix_array(live, depth=DEPTH):
    """The sorted suffixes of every host that have a neighbour in common with them, and the intervals they lie in.

    Suffixes are sorted in ranges of (host, suffix, page), so an interval of equal beginnings may spread over ranges, while a page's
    part of it lies in one. A task walks its range and compares neighbours: one that has less than its whole cut length in common with both is
    unique and goes, unless it stands at a border of the range. ``pages`` is set in one row for each interval and range: its distinct pages.
    """
    rows = pa.schema([("host", pa.string()), ("prose", pa.bool_()), ("suffix", pa.string()), ("content", pa.binary()), ("block", pa.int32()), ("place", pa.int32())])
    walked = pa.schema([("host", pa.string()), ("prose", pa.bool_()), ("beginning", pa.binary()), ("content", pa.binary()), ("block", pa.int32()),
                        ("place", pa.int32()), ("pages", pa.int64())])

    def cut(batches):
        for batch in batches:
            yield from flushed(((host, not own[n]["open"], s, content, n, i) for host, content, own, some in rows_of(batch, "host", "content", "blocks", "live")
                                for n in some for i, s in _suffixes(own[n]["text"], own[n]["open"], depth)), rows)

    def walk(batches):
        def intervals():
            key, held, digest, pages, last, first = None, None, None, 0, None, True
            for batch in batches:
                for row in rows_of(batch, *rows.names):
                    if row[:3] != key:  # less in common than the cut: an interval ends
                        if held and first:  # the first of a range may go on from the one before
                            yield *held, None
                        if key and (first or not held):
                            yield *key[:2], digest, None, None, None, pages
                        first = key is None
                        key, held, pages, last = row[:3], None, 0, None
                        digest = _digest(key[2])
                    place = *key[:2], digest, *row[3:]
                    if pages == 0:
                        held = place
                    else:
                        if held:
                            yield *held, None
                            held = None
                        yield *place, None
                    pages += row[3] != last
                    last = row[3]
            if key:  # so may the last go on in the next
                if held:
                    yield *held, None
                yield *key[:2], digest, None, None, None, pages

        yield from flushed(intervals(), walked)

    suffixes = live.mapInArrow(cut, "host string, prose boolean, suffix string, content binary, block int, place int").dropDuplicates()
    order = ["host", "prose", "suffix", "content"]
    ordered = suffixes.repartitionByRange(*order).sortWithinPartitions(*order, "block", "place")
    return settle(ordered.mapInArrow(walk, "host string, prose boolean, beginning binary, content binary, block int, place int, pages bigint"), "array")


def repeated(parsed, depth=DEPTH):
    """``host, content, places``: (block, word, many) where a substring starts in a page's blocks that another page of its host has too.

    ``many`` marks those that enough pages of the host share; of prose only those are given, and blocks of less than LONG words stand for themselves, at word -1.
    Blocks that share no anchor do not come into the suffix array. No suffix runs into another block. Pages count as distinct by their content,
    so copies of a page do not make it boilerplate.
    """
    sizes = settle(parsed.groupBy("host").agg(F.countDistinct("content").alias("pages")), "sizes")
    array = suffix_array(parsed.select("host", "content", "blocks").join(_live(parsed, sizes, depth), ["host", "content"]), depth)
    counts = array.where("pages is not null").groupBy("host", "prose", "beginning").agg(F.sum("pages").alias("n")).where("n > 1")
    judged = counts.join(sizes, "host").select("host", "prose", "beginning", (F.col("n") >= _enough()).alias("many"))
    common = judged.where("many or not prose")
    return (array.where("pages is null").drop("pages").join(common, ["host", "prose", "beginning"])
            .groupBy("host", "content").agg(F.collect_set(F.struct("block", "place", "many")).alias("places")))


def unique_text(own, places, depth=DEPTH):
    """Blocks without what is repeated: whole blocks, stretches of prose, and runs of covered words of open blocks that are long or stand at an end.

    Overlapping repeats make one run, which goes if many pages share a part of it; words left over of a block stay as one block.
    """
    at, out = {}, []
    for p in places:
        at.setdefault(p["block"], []).append((p["place"], p["many"]))
    for n, (text, is_open) in enumerate(own):
        if n in at:
            words = text.split()
            covered = [False] * len(words)
            runs = []
            for i, many in sorted(at[n]):
                past = min(i + (depth if is_open else max(LONG, depth)), len(words)) if i >= 0 else len(words)
                if runs and i < runs[-1][1]:
                    runs[-1] = runs[-1][0], past, runs[-1][2] or many
                else:
                    runs.append((max(i, 0), past, many))
            for first, past, many in runs:
                if many and (not is_open or first == 0 or past == len(words) or past - first >= LONG):
                    covered[first:past] = [True] * (past - first)
            text = " ".join(w for w, c in zip(words, covered) if not c)
        if text:
            out.append(text)
    return "\n".join(out)


def extract(pages, depth=DEPTH, id_col="page_id", url_col="url", html_col="html"):
    """``page_id, url, text, n_chars`` of every page.

    Structure decides what it can: an article's headings, paragraphs, lists and tables are main text, menus, headers,
    footers, sidebars, adverts, forms and comments are not. Inside an article a block goes if a part of its class or id tells of comments, adverts,
    notices or the like; a wrapper that holds the article, or all of its text, stays. What it leaves open, loose containers and pages without
    an article, goes to the suffix array of the page's host: substrings of ``depth`` words or more that a quarter of its distinct pages
    share are boilerplate if they are long or stand at an end of their block; unique runs stay. Prose of an article stands in the
    array too: stretches of LONG words or more, and whole shorter blocks, go if half of the host's distinct pages share them and five at least.

    NULL and empty pages give an empty text, NULL URLs and ids stay, a page without host shares the empty host. Repeated
    rows stay; extra columns are left out; an empty table gives an empty table.
    """
    named = bare(pages, page_id=id_col, url=url_col, html=html_col).withColumn("host", host_of(F.col("url")))
    parsed = settle_text(_parsed(named.select("page_id", "url", "host", "html")), "pages")
    places = settle(repeated(parsed, depth), "places")
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])

    def run(batches):
        for batch in batches:
            yield from flushed(((i, url, unique_text([(b["text"], b["open"]) for b in own], places or [], depth))
                                for i, url, own, places in rows_of(batch, "page_id", "url", "blocks", "places")), schema, 200)

    judged = parsed.join(places, ["host", "content"], "left").select("page_id", "url", "blocks", "places")
    found = judged.mapInArrow(run, "page_id bigint, url string, text string")
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
