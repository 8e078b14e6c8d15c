"""Main text of web pages by differencing each with its nearest page by URL path within its host.

Pages go in order of (host, path, id); each is aligned, line by line, with whichever neighbour of its host shares more
of the path, and lines of a longest common subsequence are the site's own and go. A neighbour that has nearly all of the
page's lines may be a copy of it, or another page of a site whose frame is most of every page: of what such a neighbour
shares, only lines go that over two thirds of the host's different pages have. Two things alignment can't know are decided by markup: lines
inside an article stay even if a copy of the page shares them, and menus, headers, footers, adverts and the like go even
where they change from page to page. On a page with an article markup decides all lines, and alignment isn't computed:
what neighbouring articles share is text that both of them quote.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.shared import NO_ID, hash_sample, id_or_none, known_id

OPEN, MAIN, FRAME = 0, 1, 2
#: Elements whose content is no text of the page.
SILENT = frozenset("script style noscript template svg math iframe object canvas audio video select textarea button head title".split())
#: Elements that frame a page, whatever they hold.
FRAMING = frozenset("nav header footer aside form menu dialog".split())
RAW = frozenset("script style textarea title noscript iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr caption ul".split())
ROOTS = frozenset(("article", "main"))
ROOT_ROLES = frozenset(("main", "article"))
FRAME_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar".split())
#: Words of class and id attributes that mark framing elements.
FRAME_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation breadcrumb breadcrumbs header masthead footer sidebar widget widgets notice notices cookie cookies consent gdpr popup modal overlay comment comments disqus respond reply replies reactions share sharing social newsletter subscribe subscription signup login related recommended pagination pager toolbar skip".split())
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
SPACES = re.compile(r"\s+")
WORDS = re.compile(r"[a-z]+")
#: Pages sampled per bucket to place the buckets' bounds.
SAMPLE = 32
#: Pages whose undecided lines are alike in over this share may be copies of each other; what they share is then the
#: site's only where over two thirds of the host's different pages have it, and the host has so many at least.
COPY, LEAST_PAGES = 0.8, 3
#: Markup of pages with an article, which are decided without alignment.
ARTICLE = r"(?i)<(article|main)\b|\brole\s*=\s*[\"']?(article|main)\b"
#: Rows of a bucket: pages, pages of the neighbouring bucket, and the site's lines of a host.
PAGE, GUEST, SITE = 0, 1, 2
#: A line of which two pages have more pairs than this is shared as often as both have it, wherever it stands.
MOST_PAIRS = 4096


def framing_names(names: str, root: bool, inside: bool) -> bool:
    """Whether classes or ids mark framing: any word of a name does; of an article's own names the first word counts.

    Names that tell what else a page has (has-sidebar, no-comments) mark nothing, nor does a header inside an article.
    """
    for name in names.split():
        own = WORDS.findall(name)
        if not own or own[0] in ("has", "with", "no", "without", "is"):
            continue
        found = FRAME_WORDS.intersection(own[:1] if root else own)
        if found and not (inside and found <= {"header"}):
            return True
    return False


def zone_of(tag: str, attributes: str, outer: int) -> int:
    """Zone of an element: what frames the page stays FRAME all the way down; an article opens MAIN."""
    if outer == FRAME or tag in SILENT:
        return FRAME
    role, names, hidden = "", "", False
    if attributes.strip(" /"):
        for m in ATTRIBUTE.finditer(attributes):
            name = m[1].lower()
            value = (m[2] or m[3] or m[4] or "").lower()
            if name in ("class", "id"):
                names += " " + value
            elif name == "role":
                role = value.strip()
            elif name == "hidden":
                hidden = True
    if hidden or role in FRAME_ROLES:
        return FRAME
    if tag in FRAMING and not (tag == "header" and outer == MAIN):
        return FRAME
    if names and tag not in ("html", "body", "main") and framing_names(names, tag in ROOTS, outer == MAIN):
        return FRAME
    return MAIN if tag in ROOTS or role in ROOT_ROLES else outer


def lines_of(page: str) -> list[tuple[str, int]]:
    """Lines of text of a page in order, each with its zone: a block's text, references decoded, white space as one space."""
    lines: list[tuple[str, int]] = []
    parts: list[str] = []
    stack: list[tuple[str, int]] = []
    zone = OPEN

    def close() -> None:
        if parts:
            text = SPACES.sub(" ", entities.unescape("".join(parts))).strip()
            parts.clear()
            if text:
                lines.append((text, zone))

    at, n = 0, len(page)
    while at < n:
        m = TOKEN.search(page, at)
        if m is None:
            parts.append(page[at:])
            break
        if m.start() > at:
            parts.append(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag in BLOCKS:
                close()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    outer = stack[i][1]
                    if outer != zone:
                        close()
                    del stack[i:]
                    zone = outer
                    break
            continue
        if tag in BLOCKS:
            close()
            if stack and stack[-1][0] == "p" and tag != "p":
                zone = stack.pop()[1]
            elif tag in ("p", "li", "dd", "dt", "tr"):
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        zone = stack[i][1]
                        del stack[i:]
                        break
                    if stack[i][0] in BLOCKS:
                        break
        elif tag in ("br", "td", "th", "img"):
            parts.append(" ")
        if tag in VOID or m[3].endswith("/"):
            continue
        inner = zone_of(tag, m[3], zone)
        if tag in RAW:
            stop = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = stop.end() if stop else n
            continue
        if inner != zone:
            close()
        stack.append((tag, zone))
        zone = inner
    close()
    return lines


def common(a: list[str], b: list[str]) -> set[int]:
    """Indexes of a's lines that a longest common subsequence with b has (Hunt and Szymanski: over matches, not all pairs).

    Equal ends are shared and never looked at. A line that both repeat so often that its pairs outnumber MOST_PAIRS
    stands outside the alignment: its first occurrences are shared, as many as the other page has. Without such lines
    the subsequence is longest.
    """
    n = min(len(a), len(b))
    head = next((i for i in range(n) if a[i] != b[i]), n)
    tail = next((i for i in range(n - head) if a[-1 - i] != b[-1 - i]), n - head)
    found = {*range(head), *range(len(a) - tail, len(a))}
    mine, theirs = Counter(a[head : len(a) - tail]), Counter(b[head : len(b) - tail])
    often = {x: theirs[x] for x, k in mine.items() if k * theirs[x] > MOST_PAIRS}
    places: dict[str, list[int]] = {}
    for j in range(head, len(b) - tail):
        if b[j] not in often:
            places.setdefault(b[j], []).append(j)
    tails: list[int] = []
    links: list[tuple] = []
    for i in range(head, len(a) - tail):
        if often.get(a[i], 0) > 0:
            often[a[i]] -= 1
            found.add(i)
        for j in reversed(places.get(a[i], ())):
            k = bisect_left(tails, j)
            link = (i, links[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                links.append(link)
            else:
                tails[k] = j
                links[k] = link
    link = links[-1] if links else None
    while link:
        found.add(link[0])
        link = link[1]
    return found


def main_text(lines: list[tuple[str, int]], partner: list[tuple[str, int]] | None, site: set[int] | None = None) -> str:
    """With an article, the article; else the lines that the partner doesn't share and markup doesn't rule out.

    What a partner shares that may be a copy goes only as far as the site's lines, by their hashes, have it.
    """
    if any(z == MAIN for _, z in lines):
        return "\n".join(x for x, z in lines if z == MAIN)
    shared = common([x for x, _ in lines], [x for x, _ in partner]) if partner else set()
    if partner and copies(open_lines(lines), open_lines(partner)):
        shared = {i for i in shared if line_hash(lines[i][0]) in (site or ())}
    return "\n".join(x for i, (x, z) in enumerate(lines) if z == OPEN and i not in shared)


def open_lines(lines: list[tuple[str, int]]) -> list[str]:
    """The lines that markup leaves undecided."""
    return [x for x, z in lines if z == OPEN]


def copies(a: list[str], b: list[str]) -> bool:
    """Whether lines are the same but for a few."""
    both = (Counter(a) & Counter(b)).total()
    return both >= COPY * max(len(a), len(b))


def line_hash(line: str) -> int:
    """64 bits of a line."""
    return int.from_bytes(hashlib.blake2b(line.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def outlines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(host, page, hashes) of each page: the undecided lines as a set of hashes, and one hash of them in order."""
    for pages in batches:
        rows = []
        for url, page in zip(pages["url"], pages["html"], strict=True):
            own = open_lines(lines_of(page)) if isinstance(page, str) else []
            rows.append((place(url if isinstance(url, str) else None)[0], line_hash("\n".join(own)), sorted({line_hash(x) for x in own})))
        yield pd.DataFrame(rows, columns=["host", "page", "hashes"])


def site_lines(pages: DataFrame) -> DataFrame:
    """(host, hashes) of the lines that over two thirds of a host's different pages without an article have, of LEAST_PAGES such
    pages or more. Equal pages count once. A host has at most 1.5 times as many of these lines as its pages have on average."""
    open_pages = pages.where(F.col("html").isNotNull() & ~F.col("html").rlike(ARTICLE)).select("url", "html")
    different = open_pages.mapInPandas(outlines, "host string, page long, hashes array<long>").dropDuplicates(["host", "page"])
    totals = different.groupBy("host").agg(F.count(F.lit(1)).alias("total")).where(F.col("total") >= LEAST_PAGES).select(F.col("host").alias("of"), "total")
    counts = different.select("host", F.explode("hashes").alias("hash")).groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return counts.join(totals, F.col("host") == F.col("of")).where("3 * n > 2 * total").groupBy("host").agg(F.collect_list("hash").alias("hashes"))


def laid_out(batches: Iterator[pd.DataFrame], bounds: list[tuple]) -> Iterator[pd.DataFrame]:
    """A host's lines as rows for every bucket that may hold one of its pages, ahead of them."""
    packer = zstandard.ZstdCompressor(level=3)
    for hosts in batches:
        rows = []
        for host, hashes in zip(hosts["host"], hosts["hashes"], strict=True):
            packed = packer.compress(json.dumps([int(x) for x in hashes]).encode())
            first, last = bisect_right(bounds, (host, "", NO_ID)), bisect_right(bounds, (host + "\0", "", NO_ID))
            rows += [(b, host, "", NO_ID, None, packed, SITE) for b in range(first, last + 1)]
        yield pd.DataFrame(rows, columns=["bucket", "host", "path", "page_id", "url", "packed", "kind"])


def place(url: str | None) -> tuple[str, str]:
    """(host, path) of a URL, lower-case host, without query and fragment."""
    rest = (url or "").split("://", 1)[-1]
    rest = re.split(r"[?#]", rest, maxsplit=1)[0]
    host, _, path = rest.partition("/")
    return host.lower(), "/" + path.strip("/")


def likeness(a: str, b: str) -> int:
    """Characters of path that two pages share from the start."""
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(host, path, page_id) of each (page_id, url)."""
    for pages in batches:
        rows = [(*place(u if isinstance(u, str) else None), i) for i, u in zip(pages["page_id"], pages["url"], strict=True)]
        yield pd.DataFrame(rows, columns=["host", "path", "page_id"])


def bucketed(batches: Iterator[pd.DataFrame], bounds: list[tuple]) -> Iterator[pd.DataFrame]:
    """The lowest and highest key of each bucket."""
    ends: dict[int, list[tuple]] = {}
    for keys in batches:
        for k in zip(keys["host"], keys["path"], keys["page_id"].tolist(), strict=True):
            b = bisect_right(bounds, k)
            e = ends.setdefault(b, [k, k])
            e[0], e[1] = min(e[0], k), max(e[1], k)
    rows = [(b, *e[0], *e[1]) for b, e in ends.items()]
    yield pd.DataFrame(rows, columns=["bucket", "h0", "p0", "i0", "h1", "p1", "i1"])


def dealt(batches: Iterator[pd.DataFrame], bounds: list[tuple], guests: dict[tuple, list[int]]) -> Iterator[pd.DataFrame]:
    """Pages as packed lines with their bucket, and once more, as guests, in buckets whose edge they neighbour."""
    packer = zstandard.ZstdCompressor(level=3)
    for pages in batches:
        rows = []
        for i, url, page in zip(pages["page_id"].tolist(), pages["url"], pages["html"], strict=True):
            key = (*place(url if isinstance(url, str) else None), i)
            lines = lines_of(page) if isinstance(page, str) else []
            packed = packer.compress(json.dumps(lines, ensure_ascii=False).encode("utf-8", "replace"))
            url = url if isinstance(url, str) else None
            rows.append((bisect_right(bounds, key), *key, url, packed, PAGE))
            rows += [(b, *key, None, packed, GUEST) for b in guests.get(key, ())]
        yield pd.DataFrame(rows, columns=["bucket", "host", "path", "page_id", "url", "packed", "kind"])


def differenced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(page_id, url, text, n_chars) from pages in order of (bucket, host, path, page_id): three pages are held at once."""
    opener = zstandard.ZstdDecompressor()

    def rows() -> Iterator[tuple]:
        site, of = set(), None
        for pages in batches:
            for r in pages.itertuples(index=False):
                held = json.loads(opener.decompress(bytes(r.packed)))
                if r.kind == SITE:
                    site, of = set(held), (r.bucket, r.host)
                else:
                    yield r.bucket, r.host, r.path, r.page_id, r.url, held, r.kind, site if of == (r.bucket, r.host) else None

    def result(before: tuple | None, now: tuple, after: tuple | None) -> tuple:
        if any(z == MAIN for _, z in now[5]):
            before = after = None
        # Of two neighbours one that can't be a copy is a better partner, whatever its path.
        near = [(not copies(open_lines(x[5]), open_lines(now[5])), likeness(x[2], now[2]), x) for x in (before, after) if x is not None and x[0] == now[0] and x[1] == now[1]]
        partner = max(near, key=lambda x: x[:2], default=(None, None, None))[2]
        text = main_text(now[5], partner[5] if partner else None, now[7])
        return now[3], now[4] if isinstance(now[4], str) else None, text, len(text)

    names, out = ["page_id", "url", "text", "n_chars"], []
    before = now = None
    for after in rows():
        if now is not None and now[6] == PAGE:
            out.append(result(before, now, after))
        before, now = now, after
        if len(out) >= 500:
            yield pd.DataFrame(out, columns=names)
            out = []
    if now is not None and now[6] == PAGE:
        out.append(result(before, now, None))
    yield pd.DataFrame(out, columns=names)


def main_texts(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of each page, from whole pages.

    Buckets of the order (host, path, id) are bounded by a hash sample of about SAMPLE keys per shuffle partition, so that
    a host with a third of all pages is many buckets; the pages next to a bound (two per bucket, from an aggregate over
    keys alone) go to both sides as guests, which makes every page's neighbours the same whatever the bounds. One
    shuffle of packed lines. Null html is an empty page; null urls share an empty host; a page alone on its host is
    aligned with nothing. Copies of a page don't blank it: beside a neighbour that has over COPY of its lines, only lines of
    over two thirds of the host's different pages go, and none if there are fewer than LEAST_PAGES of them. An empty table gives
    an empty one.
    """
    spark = pages.sparkSession
    own = pages.select(id_or_none(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = own.select("page_id", "url").mapInPandas(keyed, "host string, path string, page_id long")
    # Rows are drawn by their number, so that rows that share an id or are equal aren't drawn together.
    drawn = hash_sample(own.select("page_id", "url", F.monotonically_increasing_id().alias("number")), "number", SAMPLE * parts, own.count())
    sample = sorted((r.host, r.path, r.page_id) for r in drawn.select("page_id", "url").mapInPandas(keyed, "host string, path string, page_id long").collect())
    bounds = [sample[len(sample) * i // (2 * parts)] for i in range(1, 2 * parts)] if sample else []
    bounds = sorted(set(bounds))
    ends: dict[int, list[tuple]] = {}
    for r in keys.mapInPandas(lambda b: bucketed(b, bounds), "bucket long, h0 string, p0 string, i0 long, h1 string, p1 string, i1 long").groupBy("bucket").agg(F.min(F.struct("h0", "p0", "i0")).alias("low"), F.max(F.struct("h1", "p1", "i1")).alias("high")).collect():
        ends[r.bucket] = [tuple(r.low), tuple(r.high)]
    guests: dict[tuple, list[int]] = {}
    order = sorted(ends)
    for a, b in zip(order, order[1:], strict=False):
        guests.setdefault(ends[a][1], []).append(b)
        guests.setdefault(ends[b][0], []).append(a)
    kind = "bucket long, host string, path string, page_id long, url string, packed binary, kind int"
    rows = own.mapInPandas(lambda b: dealt(b, bounds, guests), kind)
    rows = rows.unionAll(site_lines(own).mapInPandas(lambda b: laid_out(b, bounds), kind))
    laid = rows.repartition(parts, "bucket").sortWithinPartitions("bucket", "host", "path", "page_id", "kind")
    return laid.mapInPandas(differenced, "page_id long, url string, text string, n_chars long").withColumn("page_id", known_id("page_id"))
