"""Main text of web pages by sorted suffixes over the pages of a host.

Pages are cut into blocks (runs of text between block tags), each with the structure it stands
in. Substrings of ``min_tokens`` tokens are sorted as the suffixes of a section of the host's distinct pages, cut at that depth, and those on a large share
of a section's pages are counted over all pages of the host: a substring on a share of the host's pages is on that share of some section's. A token is
common where such a substring is on a large share of the host's pages; how large, the block's structure says: a quarter
(``open_share``) of the pages outside articles, half (``article_share``) inside an article, where passages that some pages quote are main
text. Blocks covered by common tokens are boilerplate and removed, wherever they stand; so is what is marked
as a menu, header, footer, sidebar, notice, advert, form or comment. The unique runs of the article that stay are the text, and those outside it
too where the article's part is small (teaser cards) or there is none. Marked parts are left out of the token streams.

Pages of a host with equal html are one page, parsed and compared once, whose text all its rows get: copies do not
make each other boilerplate. A host is dealt by a hash of the blocks over sections of about ``shard_pages`` distinct pages or
``shard_bytes`` bytes (a dozen pages at least), so that no host meets whole in one task; the sections decide nothing of the result.
"""
from __future__ import annotations

import html as htmllib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, bounded_hint, group_bounds, runs, write_table

RAW = "script|style|noscript|template|textarea|iframe|svg|math|object|title|xmp|canvas"
#: a comment, declaration, element of raw text with its contents, or a tag
TAG = re.compile(rf"<!--.*?(?:-->|\Z)|<(?:!|\?)[^>]*(?:>|\Z)|<({RAW})(?=[\s/>])[^>]*(?:>.*?(?:</\1\s*>|\Z)|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S | re.I)
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: elements whose contents are not main text
ASIDE = set("nav footer aside form menu button select dialog head option fieldset figcaption".split()) - {"figcaption"}
#: elements that hold the main text
MAIN = {"article", "main"}
HINT = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert|adverts|advertisement|advertising|sponsor|sponsored|promo|banner|nav|navbar|navigation|menu|breadcrumb|breadcrumbs|header|masthead|footer|sidebar|side|"
    r"cookie|cookies|consent|notice|notices|gdpr|popup|modal|newsletter|subscribe|signup|login|comment|comments|disqus|respond|replies|related|recommended|share|social|widget|toolbar|pagination)(?:$|[\s_-])", re.I)
#: words that say nothing of an element inside an article, or of one that holds an article
PLACES = re.compile(r"(?:^|(?<=[\s_-]))(?:header|side)(?=$|[\s_-])", re.I)
#: words of elements that often hold articles (teasers, comments) without holding the page's own
OTHERS = re.compile(r"(?:^|[\s_-])(?:comment|comments|disqus|respond|replies|related|recommended|widget)(?:$|[\s_-])", re.I)
#: class names that tell what an element has beside it: has-sidebar, layout--no-sidebar, with-nav
BESIDE = re.compile(r"(?:^|(?<=\s))(?:\S*[_-])?(?:has|no|with|without)[_-]\S*", re.I)
ATTR = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "menu", "menubar", "dialog", "alert", "form"}
GAP = re.compile(r"\s+")

ARTICLE, OPEN, DROPPED = 0, 1, 2


def _hint(name: str, attrs: str, inside_main: bool) -> str | None:
    """The class or id that hints at an element beside the main text."""
    if name in ("body", "html") or name in MAIN:
        return None
    for key, value in ATTR.findall(attrs):
        if key.lower() in ("class", "id") and HINT.search(value.strip("\"'")):
            value = BESIDE.sub(" ", value.strip("\"'"))
            if HINT.search(PLACES.sub(" ", value) if inside_main else value):
                return value
    return None


def _aside(name: str, attrs: str, inside_main: bool, hints: bool = True) -> bool:
    if name in ASIDE or name == "header" and not inside_main:
        return True
    for key, value in ATTR.findall(attrs):
        key, value = key.lower(), value.strip("\"'")
        if key == "role" and value.lower() in ROLES or key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
    return hints and _hint(name, attrs, inside_main) is not None


def _wrappers(page: str) -> set[int]:
    """Where elements outside articles start that a class or id hints at, but that hold an article or most of the page's text."""
    held: list[list] = []      # open hinted elements: name, depth, start, characters before, whether it may hold the article
    sizes: list[tuple[int, int]] = []
    keep: set[int] = set()
    at = total = inside = 0
    for m in TAG.finditer(page):
        total += len(page[at: m.start()].strip())
        at = m.end()
        name = (m[3] or "").lower()
        if not name or name in INLINE or name in VOID:
            continue
        same = next((k for k in range(len(held) - 1, -1, -1) if held[k][0] == name), None)
        if m[2]:
            if name in MAIN:
                inside = max(0, inside - 1)
            if same is not None:
                held[same][1] -= 1
                if not held[same][1]:
                    sizes += [(h[2], total - h[3]) for h in held[same:]]
                    del held[same:]
        elif not m[4].endswith("/"):
            if name in MAIN:
                if not inside and all(h[4] for h in held):
                    keep.update(h[2] for h in held)
                inside += 1
            if not inside and (hint := _hint(name, m[4], False)) is not None:
                held.append([name, 1, m.start(), total, not OTHERS.search(hint)])
            elif same is not None:
                held[same][1] += 1
    total += len(page[at:].strip())
    sizes += [(h[2], total - h[3]) for h in held]
    return keep | {start for start, size in sizes if 2 * size > total}


def page_blocks(page: str) -> list[tuple[int, str]]:
    """(zone, text) of each block with text, in page order; zones: in an article, elsewhere, in a dropped part."""
    return list(iter_blocks(page))


def iter_blocks(page: str) -> Iterator[tuple[int, str]]:
    """The blocks of ``page_blocks`` one by one, parsed as far as they are asked for."""
    held: list[str] = []
    stack: list[tuple[str, int]] = []      # open elements that change the zone, with the zone before
    zone, depth = OPEN, {}
    at = 0
    wrappers = None            # looked for when a hint first drops an element

    def close() -> Iterator[tuple[int, str]]:
        text = GAP.sub(" ", htmllib.unescape("".join(held))).strip()
        held.clear()
        if text:
            yield zone, text

    for m in TAG.finditer(page):
        if m.start() > at:
            held.append(page[at: m.start()])
        at = m.end()
        name = (m[3] or "").lower()
        if not name:          # a comment, declaration or raw element
            if m[1]:
                held.append(" ")
            continue
        if name in INLINE:
            if name in ("br", "img", "wbr"):
                held.append(" ")
            elif not m[2] and m[4] and _aside(name, m[4], zone == ARTICLE):
                yield from close()
                stack.append((name, zone))
                depth[name] = 1
                zone = DROPPED
            elif name in depth:
                depth[name] += -1 if m[2] else 1
                if not depth[name]:
                    yield from close()
                    del depth[name]
                    while stack:
                        last, zone = stack.pop()
                        if last == name:
                            break
            continue
        yield from close()
        if name in VOID or m[4].endswith("/") and not m[2]:
            continue
        if m[2]:
            if name in depth:
                depth[name] -= 1
                if not depth[name]:
                    del depth[name]
                    while stack:       # closes what was left open inside
                        last, zone = stack.pop()
                        depth.pop(last, None)
                        if last == name:
                            break
        elif name in depth:
            depth[name] += 1
        elif zone != DROPPED:
            new = DROPPED if _aside(name, m[4], zone == ARTICLE) else ARTICLE if name in MAIN else None
            if new == DROPPED and zone == OPEN and not _aside(name, m[4], False, hints=False):
                wrappers = _wrappers(page) if wrappers is None else wrappers
                new = None if m.start() in wrappers else new
            if new is None:
                continue
            stack.append((name, zone))
            depth[name] = 1
            zone = new
    if at < len(page):
        held.append(page[at:])
    yield from close()


def run_counts(tokens: np.ndarray, page: np.ndarray, min_tokens: int) -> np.ndarray:
    """For each token, the most distinct pages that a substring of ``min_tokens`` tokens over it stands on (0: over none).

    ``page`` numbers the page of each token; no substring crosses pages. Ranks by the first 2, 4, ...
    tokens are doubled up to the depth, then equal neighbours in suffix order share the substring.
    """
    n = len(tokens)
    most = np.zeros(n, np.int64)
    if n < min_tokens:
        return most
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64) + 1
    size = 1
    while size < min_tokens:
        step = min(size, min_tokens - size)
        ahead = np.zeros(n, np.int64)
        ahead[: n - step] = rank[step:]
        rank = np.unique(rank * (n + 2) + ahead, return_inverse=True)[1].astype(np.int64) + 1
        size += step
    whole = np.full(n, False)
    whole[: n - min_tokens + 1] = page[: n - min_tokens + 1] == page[min_tokens - 1:]
    at = np.flatnonzero(whole)
    if not len(at):
        return most
    order = at[np.lexsort((page[at], rank[at]))]          # suffixes in order, to the depth
    new = np.concatenate(([True], rank[order[1:]] != rank[order[:-1]]))
    other = new | np.concatenate(([True], page[order[1:]] != page[order[:-1]]))
    group = np.cumsum(new) - 1
    count = np.zeros(n, np.int64)
    count[order] = np.bincount(group, weights=other).astype(np.int64)[group]      # distinct pages of the run that starts there
    for k in range(min_tokens):
        np.maximum(most[k:], count[: n - k], out=most[k:])
    return most


def repeated_runs(tokens: np.ndarray, page: np.ndarray, min_tokens: int) -> np.ndarray:
    """Which tokens lie in a substring of ``min_tokens`` tokens that stands on two or more distinct pages."""
    return run_counts(tokens, page, min_tokens) > 1


def _token_hashes(texts: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(x) & 0x7FFFFFFFFFFFFFFF for t in texts for x in t.split(" ")), np.int64)


#: writer options for tables of whole texts
SMALL = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9"}
#: columns that a page keeps on its way
CARRIED = ("section", "sections", "host", "h1", "h2", "many", "page_id", "url")


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        at = 0
        sizes = [len(v.as_buffer()) if v.is_valid else 0 for v in b.column("html").cast(pa.binary())]
        total = 0
        for i, s in enumerate(sizes):
            total += s
            if total >= 4 << 20 or i + 1 == len(sizes):
                part = b.slice(at, i + 1 - at)
                blocks = [[(z, x) for z, x in iter_blocks(t) if z != DROPPED] for t in part.column("html").to_pylist()]
                # one string each (a block holds no line feed, its white space is spaces), packed: the shuffle's own codec leaves half as much again
                zones = pa.array(["".join(str(z) for z, _ in p) for p in blocks], pa.string())
                raw = ["\n".join(t for _, t in p).encode() for p in blocks]
                sizes_of = pa.array([len(t) for t in raw], pa.int32())
                packed = pa.array([pa.compress(t, "zstd", asbytes=True) for t in raw], pa.binary())
                # pages with equal blocks are one page: they go to one section
                section = pa.array([xxhash.xxh64_intdigest("\0".join(t for _, t in p)) % n for p, n in zip(blocks, part.column("sections").to_pylist())], pa.int32())
                yield pa.RecordBatch.from_arrays([section, *(part.column(c) for c in CARRIED[1:]), zones, sizes_of, packed], names=[*CARRIED, "zones", "size", "packed"])
                at, total = i + 1, 0


def window_hashes(tokens: np.ndarray, page: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, 64-bit hash) of every substring of ``depth`` tokens that lies on one page."""
    n = len(tokens) - depth + 1
    if n < 1:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    t, h = tokens.view(np.uint64), np.zeros(n, np.uint64)
    for k in range(depth):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + t[k: n + k]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    at = np.flatnonzero(page[:n] == page[depth - 1:])
    return at, (h ^ (h >> np.uint64(31))).view(np.int64)[at]


def _unpacked(sizes: pa.Array, packed: pa.Array) -> pa.Array:
    """The pages' blocks as ``_parse`` packed them."""
    return pa.array([pa.decompress(p, n, "zstd", asbytes=True) for n, p in zip(sizes.to_pylist(), packed.to_pylist())], pa.binary()).cast(pa.string())


def _blocks(texts: pa.Array) -> list[list[str]]:
    return [t.split("\n") if t else [] for t in texts.to_pylist()]


def section_candidates(pages: list[list[str]], min_tokens: int, share: float, least: int) -> tuple[list[bool], np.ndarray]:
    """Which pages are the first with their blocks, and the substrings on at least ``share`` of these pages and on ``least``."""
    first: dict[tuple, int] = {}
    for i, p in enumerate(pages):
        if p:
            first.setdefault(tuple(p), i)
    distinct = sorted(first.values())
    runs_of = [_token_hashes(pages[i]) for i in distinct]
    tokens = np.concatenate([np.empty(0, np.int64), *runs_of])
    page = np.repeat(np.arange(len(distinct)), [len(t) for t in runs_of])
    at, h = window_hashes(tokens, page, min_tokens)
    order = np.lexsort((page[at], h))
    h, of = h[order], page[at][order]
    once = np.ones(len(h), bool)
    once[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
    found, n = np.unique(h[once], return_counts=True)
    chosen = set(distinct)
    return [i in chosen for i in range(len(pages))], found[n >= max(least, share * len(distinct))]


def common_share(blocks: list[str], needs: list[float], min_tokens: int, windows: np.ndarray, totals: np.ndarray) -> list[float]:
    """For each block of a page, the share of its tokens in substrings on at least ``needs`` pages (``windows`` ascending, with the pages of each)."""
    sizes = [t.count(" ") + 1 for t in blocks]
    if not len(windows):
        return [0.0] * len(blocks)
    tokens = _token_hashes(blocks)
    most, count = np.zeros(len(tokens), np.int64), np.zeros(len(tokens), np.int64)
    at, h = window_hashes(tokens, np.zeros(len(tokens), np.int8), min_tokens)
    place = np.minimum(np.searchsorted(windows, h), len(windows) - 1)
    count[at] = np.where(windows[place] == h, totals[place], 0)
    for k in range(min(min_tokens, len(tokens))):
        np.maximum(most[k:], count[: len(count) - k], out=most[k:])
    ends = np.cumsum(sizes)
    return [float((most[to - n: to] >= need).mean()) for to, n, need in zip(ends.tolist(), sizes, needs)]


def kept_blocks(zones: list[int], sizes: list[int], shares: list[float], covered_share: float, small_part: float) -> list[bool]:
    """Which blocks of a page are its main text, from their structure and the share of their tokens that is common."""
    fresh = [z != DROPPED and s < covered_share for z, s in zip(zones, shares)]
    inside = sum(n for z, n, f in zip(zones, sizes, fresh) if f and z == ARTICLE)
    outside = sum(n for z, n, f in zip(zones, sizes, fresh) if f and z == OPEN)
    open_too = inside < small_part * (inside + outside) or not inside
    return [f and (z == ARTICLE or open_too) for z, f in zip(zones, fresh)]


def _sections(min_tokens: int, share: float):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tab in runs(batches, ["section", "host"], 512):
            bounds = group_bounds(tab, ["section", "host"])
            for at, to in zip(bounds, bounds[1:]):
                part = tab.slice(int(at), int(to - at)).combine_chunks()
                texts = _unpacked(part.column("size"), part.column("packed"))
                # where a host is one section its counts are final, and fewer than three pages are never enough
                first, near = section_candidates(_blocks(texts), min_tokens, share, 3 if part.column("sections")[0].as_py() == 1 else 1)
                near_col = pa.array([near.tolist()] + [None] * (part.num_rows - 1), pa.list_(pa.int64()))
                yield from pa.table([*(part.column(c) for c in CARRIED[2:]), part.column("zones"), texts, pa.array(first), near_col],
                                    names=[*CARRIED[2:], "zones", "texts", "first", "near"]).to_batches()
    return fn


def _per_host(column: pa.Array, hosts: list, i: int, held: dict):
    """The list of row ``i`` as an array, kept while rows of one host follow each other."""
    if held.get("host") != hosts[i]:
        v = column[i]
        held["host"], held["at"] = hosts[i], v.values.to_numpy() if v.is_valid else np.empty(0, np.int64)
    return held["at"]


def _count(min_tokens: int):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hosts, held, seen = b.column("host").to_pylist(), {}, {}
            for i, texts in enumerate(_blocks(b.column("texts"))):
                near = _per_host(b.column("near"), hosts, i, held)
                tokens = _token_hashes(texts)
                seen.setdefault(hosts[i], []).append(np.intersect1d(window_hashes(tokens, np.zeros(len(tokens), np.int8), min_tokens)[1], near))
            for host, parts in seen.items():
                window, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([host] * len(window), pa.int64()), pa.array(window), pa.array(n, pa.int64())], names=["host", "window", "n"])
    return fn


def _extract(min_tokens: int, covered_share: float, open_share: float, article_share: float, small_part: float):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hosts, pages, out = b.column("host").to_pylist(), b.column("pages").to_pylist(), []
            windows, totals = {}, {}
            for i, (zones, texts) in enumerate(zip(b.column("zones").to_pylist(), _blocks(b.column("texts")))):
                zones = [int(z) for z in zones]
                need = {ARTICLE: max(5, np.ceil(article_share * (pages[i] or 0))), OPEN: max(3, np.ceil(open_share * (pages[i] or 0)))}
                shares = common_share(texts, [need[z] for z in zones], min_tokens, _per_host(b.column("windows"), hosts, i, windows), _per_host(b.column("totals"), hosts, i, totals))
                kept = kept_blocks(zones, [t.count(" ") + 1 for t in texts], shares, covered_share, small_part)
                out.append("\n".join(t for t, k in zip(texts, kept) if k))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in CARRIED[2:]), pa.array(out, pa.string())], names=[*CARRIED[2:], "text"])
    return fn


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_tokens: int = 8, covered_share: float = 0.8,
              open_share: float = 0.25, article_share: float = 0.5, small_part: float = 0.2, shard_pages: int = 1024, shard_bytes: int = 64 << 20) -> DataFrame:
    """(page_id, url, text) per row of ``pages``; the text's blocks are joined by line feeds, empty if there is none.

    A run is common from 3 distinct pages on outside articles, from 5 inside, and from the shares given; the
    article's part is small below ``small_part`` of a page's tokens that are neither common nor marked. A null page is empty; a url
    without a host (or null) belongs to the host "". Rows of a host with equal html (whatever their ids, also null) have one text.
    Pages of any length are parsed whole; a page larger than ``shard_bytes`` shares its section only by chance of its hash. An empty
    table gives an empty result; other columns are ignored.
    """
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.xxhash64(host).alias("host"), F.xxhash64(html).alias("h1"), F.xxhash64(F.lit("html"), html).alias("h2"),
                        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html"))
    key = ["host", "h1", "h2"]
    # one narrow row per distinct page of a host
    known = write_table(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"), F.max(F.octet_length("html")).alias("bytes")), "page-contents")
    sections = known.groupBy("host").agg(F.greatest(F.ceil(F.count(F.lit(1)) / shard_pages), F.least(F.ceil(F.sum("bytes") / shard_bytes), F.ceil(F.count(F.lit(1)) / 12))).cast("int").alias("sections"))
    large = write_table(sections.where("sections > 1"), "large-hosts")
    copies = known.where("copies > 1").select(*key, F.lit(True).alias("many"))
    any_copies = copies.limit(1).count() > 0
    once = rows.withColumn("many", F.lit(False))
    if any_copies:
        # copies of a page are brought together (combined map-side) and parsed once
        marked = rows.join(bounded_hint(copies), key, "left")
        none = F.lit(None)
        once = marked.where(F.col("many").isNull()).withColumn("many", F.lit(False)).unionByName(
            marked.where("many").dropDuplicates(key).withColumns({"page_id": none.cast("long"), "url": none.cast("string")}))
    spread = once.join(bounded_hint(large), "host", "left").withColumn("sections", F.coalesce("sections", F.lit(1)))
    carried = "section int, sections int, host long, h1 long, h2 long, many boolean, page_id long, url string"
    kept = carried.partition("host ")[1] + carried.partition("host ")[2]
    parsed = arrow_map(spread.select(*CARRIED[1:], "html"), _parse, f"{carried}, zones string, size int, packed binary")
    dealt = parsed.repartition("host", "section").sortWithinPartitions("section", "host", "h1", "h2")
    blocks = write_table(arrow_map(dealt, _sections(min_tokens, min(open_share, article_share)), f"{kept}, zones string, texts string, first boolean, near array<long>"), "page-blocks", options=SMALL)
    # a substring on a share of the host's pages is on that share of some section's: only these are counted over the host
    near = blocks.where("size(near) > 0").select("host", F.explode("near").alias("w")).groupBy("host").agg(F.sort_array(F.collect_set("w")).alias("near"))
    counted = arrow_map(blocks.where("first").select("host", "texts").join(bounded_hint(near), "host"), _count(min_tokens), "host long, window long, n long")
    totals = counted.groupBy("host", "window").agg(F.sum("n").alias("n"))
    sizes = blocks.where("first").groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    least = F.least(F.greatest(F.lit(5), F.ceil(F.lit(article_share) * F.col("pages"))), F.greatest(F.lit(3), F.ceil(F.lit(open_share) * F.col("pages"))))
    common = totals.join(sizes, "host").where(F.col("n") >= least).groupBy("host", "pages").agg(F.sort_array(F.collect_list(F.struct("window", "n"))).alias("c"))
    common = write_table(common.select("host", "pages", F.col("c.window").alias("windows"), F.col("c.n").alias("totals")), "common-windows")
    found = arrow_map(blocks.join(bounded_hint(common), "host", "left").select(*CARRIED[2:], "zones", "texts", "pages", "windows", "totals"),
                      _extract(min_tokens, covered_share, open_share, article_share, small_part), f"{kept}, text string")
    if any_copies:
        found = write_table(found, "page-texts")        # read twice: by page, and for the rows of a page that has copies
        mine = marked.where("many").select("page_id", "url", *key).join(found.where("many").select(*key, "text"), key).select("page_id", "url", "text")
        found = found.where("NOT many").select("page_id", "url", "text").unionByName(mine)
    return found.select(F.col("page_id").alias(id_col), F.col("url").alias(url_col), "text")
