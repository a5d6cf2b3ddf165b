"""Main text of web pages by structure and by what a host repeats (operator 10).

A page's blocks come from its markup: scripts, styles, forms, menus, page headers, footers, asides,
adverts, notices and reader comments (by element, role, class or id) are no content.  Where a page marks
its article (``article``, ``main``, ``role=main``), the text is what the article holds.  Where it does not,
the rest of the page is loose, and the host decides: the token streams of the host's pages are one
text, of which all suffixes are named by their first ``RUN`` tokens; names that occur on ``PAGES`` or
more distinct pages, and on ``PAGES_SHARE`` of the host's, are repeated substrings, and longer ones are
chains of such names.  Runs so covered are boilerplate: a loose block of which at least half lies in them
goes if no run of ``RUN`` tokens of its own is left, and so do blocks of fewer tokens made of links
that are no headings.  Pages of equal content count as one.  Names of one page count that cover most of a page
and are on no more than half of its host's pages are those of an article whose copies stand among other menus
or dates, and are no boilerplate; on a host of under ``2 * PAGES`` pages the same holds for any page count.
Names are counted by (host, name), so a host of any size is spread over all tasks.

What an article holds goes through the same search, with a higher bar, as it is known to be content: names
count if more than ``ARTICLES_SHARE`` of the host's distinct articles hold them, on hosts of ``2 * PAGES``
articles and more, and an article most of whose words they cover is a copy and stays whole.  Each task
counts stretches of its own articles and passes on the names on more than half that share of a stretch; as any
other stretch holds a name on no more than that, few names are left that may reach the share, and only these are counted
over all articles of their hosts.

A class or id marks an element only as a whole value of known words, and never a heading.

Decoded and joined: character references are decoded, white space in a block becomes one space, blocks
are trimmed and joined by a line feed, empty ones left out.  ``br`` is white space.

Defined cases: null or empty html gives an empty text; a null url belongs to the host of no name; rows
that repeat a page_id are extracted each; a cut-off tag is dropped; further columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.llm.neardup import Words, mixed
from courtline.llm.shared import exact, opaque, saved, ship, small_enough

RUN = 10
PAGES, PAGES_SHARE = 3, 0.1
ARTICLES_SHARE = 0.5
STRETCH = 2_000_000  # names that a task counts at a time
BROADCAST_HOSTS = 500_000
HOSTS_OF_NAMES = 2_000  # hosts whose repeated names are broadcast: some thousand names each at most

_RAW = "script|style|noscript|template|iframe|textarea|svg|title|select|object|canvas|math"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW})(?=[\s/>])[^>]*+>.*?(?:</\1\s*>|\Z)"
    r"""|<[/!?a-zA-Z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>|<[/!?a-zA-Z][^>]*+(?:>|\Z)""", re.S | re.I)
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""", re.I)

#: Elements that do not break a block.
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s "
                    "samp small span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold no article text wherever they stand, and those that hold none outside an article.
_NEVER = frozenset("nav footer aside form button menu dialog fieldset head".split())
_OUTSIDE = frozenset(["header"])
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog menu menubar toolbar".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Class or id values that mark what is no article text: made of these words and of _FILLERS only, so that a
#: section named by its heading (related-work, search-algorithms) is none.
_MARKS = frozenset("ad ads adv advert adverts advertisement advertisements advertising nav navigation menu footer sidebar sidebars "
                   "aside cookie cookies consent gdpr notice notices banner comment comments commentlist commentform respond reply "
                   "replies disqus share sharing social related relatedposts recommended breadcrumb breadcrumbs newsletter newsletters "
                   "subscribe subscription popup modal overlay login signup search pagination pager toolbar topbar navbar "
                   "masthead widget widgets promo promos sponsor sponsored sponsors alert".split())
_FILLERS = frozenset("a area articles article bar block body bottom box button buttons container content desktop form global icon icons "
                     "inner item items js left link links list main meta mobile outer page panel post posts primary right row secondary "
                     "section site the title top wp wrap wrapper".split())
_SKIPS = frozenset("skip skip-link skip-links skip-to-content skip-nav skip-navigation".split())
_COMMENTS = frozenset("comment comments commentlist".split())
_OUTSIDE_MARKS = frozenset("header head top".split())

MAIN, LOOSE, OTHER = 2, 1, 0


def _marked(value: str, marks: frozenset[str]) -> bool:
    """Whether one of the values is a mark as a whole: a mark's words and fillers, digits aside."""
    for one in value.split():
        words = re.findall("[^\\W\\d_]+", one)
        if any(w in marks for w in words) and all(w in marks or w in _MARKS or w in _FILLERS for w in words):
            return True
    return False


def _excluded(name: str, tag: str, in_article: bool) -> bool:
    if name in _NEVER or (name in _OUTSIDE and not in_article):
        return True
    if "=" not in tag and "hidden" not in tag:
        return False
    for key, *values in _ATTRIBUTE.findall(tag):
        key, value = key.lower(), "".join(values).lower()
        if key == "role" and value in _ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if key in ("class", "id") and name not in ("html", "body", "main") and name not in _HEADINGS:
            if _marked(value, _COMMENTS if name == "article" else _MARKS) or not _SKIPS.isdisjoint(value.split()):
                return True
            if not in_article and name != "article" and _marked(value, _OUTSIDE_MARKS):
                return True
    return False


def blocks(page: str) -> list[tuple[str, int, float]]:
    """The page's blocks in order: (text, zone, share of it in links)."""
    out: list[tuple[str, int, float]] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # name, excluded, in an article, in a link
    excluded = in_article = in_link = False
    parts: list[str] = []
    linked = 0

    def close() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            zone = OTHER if excluded else MAIN if in_article else LOOSE
            out.append((text, zone, linked / max(1, sum(map(len, parts)))))
        parts.clear()
        linked = 0

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            parts.append(page[at:m.start()])
            linked += in_link * (m.start() - at)
        at = m.end()
        t = _TAG.match(page, m.start())
        if not t or m.group(1):  # a comment, a declaration or an element whose content is no text
            if m.group(1) and m.group(1).lower() in ("title", "select", "textarea"):
                close()
            continue
        ends, name = t.group(1), t.group(2).lower()
        if name == "br":
            parts.append(" ")
            continue
        if name not in _INLINE:
            close()
        if ends:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
                if stack[k][0] in ("article", "main", "body") and name in ("p", "b", "i", "span", "a", "div", "li"):
                    break  # a stray end tag does not close the article
        elif name not in _VOID and not m.group().endswith("/>"):
            if name == "p":
                while stack and stack[-1][0] in _INLINE | {"p"}:
                    stack.pop()
            holds = name in ("article", "main") or "role" in m.group() and bool(re.search(r"role\s*=\s*[\"']?main", m.group(), re.I))
            above = stack[-1] if stack else ("", False, False, False)
            gone = above[1] or _excluded(name, m.group(), above[2] or holds)
            linking = (above[3] or name == "a") and not any(x[0] in _HEADINGS for x in stack)
            stack.append((name, gone, above[2] or (holds and not gone), linking))
        excluded, in_article, in_link = stack[-1][1:] if stack else (False, False, False)
    if at < len(page):
        parts.append(page[at:])
    close()
    return out


def host_of(url: str) -> str:
    return re.sub(r"^[a-z]+://|[/?#:].*$", "", url.lower())


def names(words: list[str], hashes: Words) -> np.ndarray:
    """Names of a stream's suffixes: hashes of their first ``RUN`` tokens; shorter suffixes have none."""
    h = np.fromiter((hashes[w.lower().encode("utf-8", "surrogatepass")] for w in words), np.uint64, len(words))
    n = max(0, len(h) - RUN + 1)
    out = np.zeros(n, np.uint64)
    for k in range(RUN if n else 0):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[k:k + n])
    return out


PARSED = "row string, page_id string, url string, host string, has_main boolean, print long, article long, others string, texts array<string>, zones array<int>, links array<double>"


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for page_id, url, page in zip(b["page_id"].tolist(), b["url"].tolist(), b["html"].tolist()):
            found = blocks(page)
            has_main = any(z == MAIN for _, z, _ in found)
            kept = [x for x in found if x[1] == MAIN] if has_main else found
            # around an article the page shows what its host repeats
            others = " ".join(x[0] for x in found if x[1] != MAIN or not has_main)
            mark = xxhash.xxh3_64_intdigest("\n".join(x[0] for x in found).encode("utf-8", "surrogatepass")) >> 1
            article = xxhash.xxh3_64_intdigest("\n".join(x[0] for x in kept).encode("utf-8", "surrogatepass")) >> 1
            host = host_of(url or "")
            rows.append((f"{page_id}/{mark}/{host}", page_id, url, host, has_main, mark, article, others,
                         *([x[k] for x in kept] for k in range(3))))
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in PARSED.split(", ")])


def _stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Host, name and page of the suffixes of pages' streams."""
    hashes = Words()
    for b in batches:
        parts = []
        for host, mark, others in zip(b["host"], b["print"], b["others"]):
            found = np.unique(names(others.split(), hashes)).view(np.int64)
            parts.append(pd.DataFrame({"host": host, "name": found, "print": mark}))
        yield pd.concat(parts) if parts else pd.DataFrame({"host": [], "name": [], "print": []})


def _article_names(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, np.ndarray]]:
    """Host and distinct names of each article."""
    hashes = Words()
    for b in batches:
        for host, texts in zip(b["host"], b["texts"]):
            yield host, np.unique(names(" ".join(texts).split(), hashes)).view(np.int64)


def _often(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Host, name, its articles and all of a stretch of the task's articles, where it is on more than half of ``ARTICLES_SHARE``."""
    held, total = defaultdict(list), 0

    def over() -> Iterator[pd.DataFrame]:
        for host, found in held.items():
            name, n = np.unique(np.concatenate(found), return_counts=True)
            many = 2 * n > ARTICLES_SHARE * len(found)
            yield pd.DataFrame({"host": host, "name": name[many], "n": n[many], "among": len(found)})
        held.clear()

    for host, found in _article_names(batches):
        held[host].append(found)
        total += len(found)
        if total > STRETCH:
            yield from over()
            total = 0
    yield from over()


def _article_stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for host, found in _article_names(batches):
        yield pd.DataFrame({"host": host, "name": found})


def _runs(words: int, found: np.ndarray, repeated: np.ndarray) -> np.ndarray:
    """Which of the words lie in a run with one of the names."""
    covered = np.zeros(words, bool)
    for k in np.flatnonzero(np.isin(found, repeated)):
        covered[k:k + RUN] = True
    return covered


def _stays(own: np.ndarray) -> bool:
    """Whether a block stays: under half of its words lie in repeated runs, or a run of its own is left."""
    return 2 * own.sum() > len(own) or max(map(len, "".join("x" if o else " " for o in own).split()), default=0) >= RUN


def _without_repeats(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Articles of hosts with repeated names, without the blocks that these make up."""
    hashes = Words()
    for b in batches:
        out = []
        for texts, repeated in zip(b["texts"], b["repeated"]):
            words = " ".join(texts).split()
            covered = _runs(len(words), names(words, hashes).view(np.int64), np.asarray(repeated, np.int64))
            kept, at = list(texts), 0
            if covered.any() and 2 * covered.sum() <= len(words):  # else a copied article
                kept = []
                for text in texts:
                    n = len(text.split())
                    if _stays(~covered[at:at + n]):
                        kept.append(text)
                    at += n
            out.append("\n".join(kept))
        yield b[["page_id", "url"]].assign(text=out)


def _unrepeated(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = Words()
    for b in batches:
        rows = []
        for row, texts, zones, links, repeated, counts, pages in zip(*(b[c] for c in ("row", "texts", "zones", "links", "repeated", "counts", "pages"))):
            lengths = [len(t.split()) for t in texts]
            words = " ".join(texts).split()
            loose = np.repeat(np.asarray(zones) == LOOSE, lengths)
            found = names(words, hashes).view(np.int64)
            covered, kept, at = np.zeros(len(words), bool), [], 0
            repeated, counts = (np.asarray(x if x is not None else [], np.int64) for x in (repeated, counts))
            for n in np.unique(counts):
                some = _runs(len(words), found, repeated[counts == n])
                if 2 * (some & loose).sum() <= loose.sum() or 2 * n > pages >= 2 * PAGES:
                    covered |= some  # else a copied article
            for text, zone, link, n in zip(texts, zones, links, lengths):
                own = ~covered[at:at + n]
                at += n
                if zone == LOOSE and (link < 0.5 or n >= RUN) and _stays(own):
                    kept.append(text)
            rows.append((row, "\n".join(kept)))
        yield pd.DataFrame(rows, columns=["row", "loose"])


def _repeated_in_articles(articles: DataFrame) -> DataFrame:
    """Host and ``repeated``, the names that more than ``ARTICLES_SHARE`` of its distinct articles hold."""
    marks = articles.select("at", "host", "article")
    first = saved(marks.groupBy("host", "article").agg(F.min("at").alias("first"), F.count("*").alias("n")), "articles")
    sizes = saved(first.groupBy("host").agg(F.count("*").alias("articles")).filter(F.col("articles") >= 2 * PAGES), "host-articles")
    several = first.filter("n > 1").select("host", "article", "first")
    several = F.broadcast(several) if small_enough(several, BROADCAST_HOSTS) else several
    again = saved(marks.join(several, ["host", "article"]).filter("at <> first").select("at"), "article-copies")
    again = F.broadcast(again) if small_enough(again, BROADCAST_HOSTS) else again
    sizes = F.broadcast(sizes) if small_enough(sizes, BROADCAST_HOSTS) else sizes
    distinct = articles.join(again, "at", "left_anti").join(sizes, "host", "left_semi").select("host", "texts")
    kind = "host string, name long"
    often = distinct.mapInPandas(_often, f"{kind}, n long, among long").groupBy("host", "name").agg(F.sum("n").alias("n"), F.sum("among").alias("among"))
    most = F.col("n") + ARTICLES_SHARE / 2 * (F.col("articles") - F.col("among"))
    often = saved(often.join(sizes, "host").filter(most > ARTICLES_SHARE * F.col("articles")).select("host", "name"), "often")
    hosts = saved(often.select("host").distinct(), "often-hosts")
    hosts = F.broadcast(hosts) if small_enough(hosts, BROADCAST_HOSTS) else hosts
    often = F.broadcast(often) if small_enough(often, BROADCAST_HOSTS) else often
    found = distinct.join(hosts, "host", "left_semi").mapInPandas(_article_stream, kind).join(often, ["host", "name"], "left_semi")
    found = found.groupBy("host", "name").agg(F.count("*").alias("n")).join(sizes, "host").filter(F.col("n") > ARTICLES_SHARE * F.col("articles"))
    return saved(found.groupBy("host").agg(F.collect_list("name").alias("repeated")), "repeated-in-articles")


def main_text(pages: DataFrame) -> DataFrame:
    """Per row of ``pages``: page_id, url, text, n_chars (see the module's text)."""
    ship(pages.sparkSession)
    source = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    parsed = exact(opaque(source, "page_id").mapInPandas(_parse, PARSED), "page_id")
    parsed = saved(parsed.withColumn("at", F.monotonically_increasing_id()), "page-blocks")
    loose = parsed.filter("not has_main")
    kind = "host string, name long, print long"
    suffixes = parsed.select("host", "print", "others").mapInPandas(_stream, kind)
    repeated = suffixes.distinct().groupBy("host", "name").agg(F.count("*").alias("n")).filter(F.col("n") >= PAGES)
    sizes = saved(parsed.select("host", "print").distinct().groupBy("host").agg(F.count("*").alias("pages")), "host-pages")
    sizes = F.broadcast(sizes) if small_enough(sizes, BROADCAST_HOSTS) else sizes
    repeated = repeated.join(sizes, "host").filter(F.col("n") >= PAGES_SHARE * F.col("pages"))
    # back to the loose pages that hold a repeated name: one row per page, its names gathered
    held = loose.select("host", "print", "others").mapInPandas(_stream, kind).distinct() \
        .join(repeated, ["host", "name"]).groupBy("host", "print").agg(F.collect_list(F.struct("name", "n")).alias("r"), F.first("pages").alias("pages"))
    held = held.select("host", "print", F.col("r.name").alias("repeated"), F.col("r.n").alias("counts"), "pages")
    judged = loose.dropDuplicates(["row"]).join(held, ["host", "print"], "left").select("row", "texts", "zones", "links", "repeated", "counts", "pages") \
        .mapInPandas(_unrepeated, "row string, loose string")
    loose_out = loose.select("row", "page_id", "url").join(judged, "row").select("page_id", "url", F.col("loose").alias("text"))
    articles = parsed.filter("has_main")
    repeated = _repeated_in_articles(articles)
    repeated = F.broadcast(repeated) if small_enough(repeated, HOSTS_OF_NAMES) else repeated
    whole = articles.join(repeated, "host", "left_anti").select("page_id", "url", F.array_join("texts", "\n").alias("text"))
    judged = opaque(articles.join(repeated, "host").select("page_id", "url", "texts", "repeated"), "page_id")
    main_out = whole.union(exact(judged.mapInPandas(_without_repeats, "page_id string, url string, text string"), "page_id"))
    out = main_out.union(loose_out)
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
