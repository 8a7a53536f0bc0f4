"""Listings and pages: what they link to, and when they were published.

Only the parsing itself runs in Python, batch by batch: it gives raw links in document order. What makes a link valid, which
one of several counts, and every cap are column expressions and windows on top.
"""

from __future__ import annotations

import json
import xml.etree.ElementTree as ET
import zlib
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.functions.dates import parse_datetime
from siftline.functions.text import text_or_empty
from siftline.functions.urls import article_score, canonicalize_url, date_from_url, outside_window, same_domain, same_site
from siftline.operators.order import cut
from siftline.operators.pick import ranked

MOST_LINKS, MOST_DOCUMENTS, MOST_DEPTH, MOST_ITEMS, LEAST_SCORE = 25, 100, 4, 1000, 3
FEED_TYPES = ("application/rss+xml", "application/atom+xml", "application/feed+json")
# Names under which pages state their date.
DATE_NAMES = ("article:published_time", "date", "datepublished", "dc.date", "parsely-pub-date", "pubdate", "publishdate", "sailthru.date")
JSON_DATE_NAMES = ("datepublished", "datecreated", "uploaddate")
#: Bytes read at once, of one entry (or one JSON listing), and of one unpacked listing; rows handed on at once.
CHUNK, MOST_ENTRY, MOST_UNPACKED, ROWS = 1 << 16, 16 << 20, 1 << 30, 10_000
_LINKS = "kind string, role string, pos int, link string, title string, published string"


class _Page(HTMLParser):
    """Anchors with their text, alternate feeds, stated dates."""

    def __init__(self, text: str):
        super().__init__(convert_charrefs=True)
        self.anchors: list[tuple[str, str]] = []
        self.feeds: list[str] = []
        self.dates: list[str] = []
        self._open: list[str] | None = None
        self._href = ""
        self._data: list[str] | None = None
        self.data: list[str] = []
        self.feed(text)

    def handle_starttag(self, tag, attrs):
        has = {k.lower(): v for k, v in attrs if v}
        if tag == "a" and "href" in has and self._open is None:
            self._href, self._open = has["href"], []
        elif tag == "link" and "href" in has and "alternate" in has.get("rel", "").lower().split() and has.get("type", "").lower() in FEED_TYPES:
            self.feeds.append(has["href"])
        elif tag == "meta" and "content" in has and (has.get("property") or has.get("name") or has.get("itemprop") or "").lower() in DATE_NAMES:
            self.dates.append(has["content"])
        elif tag == "time" and "datetime" in has:
            self.dates.append(has["datetime"])
        elif tag == "script" and has.get("type", "").lower() == "application/ld+json":
            self._data = []

    def handle_data(self, data):
        for part in (self._open, self._data):
            if part is not None:
                part.append(data)

    def handle_endtag(self, tag):
        if tag == "a" and self._open is not None:
            self.anchors.append((self._href, " ".join(" ".join(self._open).split())))
            self._open = None
        elif tag == "script" and self._data is not None:
            self.data.append("".join(self._data))
            self._data = None


def _dates_in(value) -> Iterator[str]:
    """Dates in a JSON value, depth first, without recursion limits to worry about."""
    todo = [(None, value)]
    while todo:
        key, now = todo.pop()
        if isinstance(now, str):
            if key and key.lower() in JSON_DATE_NAMES:
                yield now
        elif isinstance(now, dict):
            todo += reversed(list(now.items()))
        elif isinstance(now, list):
            todo += [(None, v) for v in reversed(now)]


def page_dates(text: str) -> list[str]:
    page = _Page(text)
    out = list(page.dates)
    for block in page.data:
        try:
            out += _dates_in(json.loads(block))
        except ValueError:
            continue
    return out


def _local(tag) -> str:
    return str(tag).rsplit("}", 1)[-1].lower()


def _text(node: ET.Element, *names: str) -> str:
    """The text of the first child or descendant with one of the names, in order of the names."""
    for name in names:
        for found in node.iter():
            if found is not node and _local(found.tag) == name and (found.text or "").strip():
                return found.text.strip()
    return ""


class TooLarge(ValueError):
    """A listing that unpacks to more than is taken, or has a single entry of more than is held."""


def _unpacked(content: bytes) -> Iterator[bytes]:
    """The content in chunks, gzip members unpacked one after the other; ValueError where they are broken."""
    if content[:2] != b"\x1f\x8b":
        yield from (content[i : i + CHUNK] for i in range(0, len(content), CHUNK))
        return
    total, rest = 0, content
    while rest[:2] == b"\x1f\x8b":
        unpack = zlib.decompressobj(31)
        while not unpack.eof:
            try:
                out = unpack.decompress(rest, CHUNK)
            except zlib.error as e:
                raise ValueError("broken gzip") from e
            if not out and not unpack.eof:
                raise ValueError("cut gzip")
            rest, total = unpack.unconsumed_tail, total + len(out)
            if total > MOST_UNPACKED:
                raise TooLarge
            yield out
        rest = unpack.unused_data


def _xml_rows(chunks: Iterator[bytes]) -> Iterator[tuple[str, str, str, str, str]]:
    """The rows of an XML listing as they are read: an element is let go of once it has ended."""
    parser = ET.XMLPullParser(("start", "end"))
    kind, inside, held = "", [], 0

    def events() -> Iterator:
        nonlocal held
        for chunk in chunks:
            held += len(chunk)
            if held > MOST_ENTRY:
                raise TooLarge
            parser.feed(chunk)
            yield from parser.read_events()
        parser.close()
        yield from parser.read_events()

    for event, node in events():
        if event == "start":
            kind = kind or _local(node.tag)
            if kind not in ("sitemapindex", "urlset", "rss", "feed", "rdf"):
                raise ValueError("not a listing")
            inside.append(node)
            continue
        inside.pop()
        if kind == "sitemapindex" and len(inside) == 1:
            yield kind, "child", _text(node, "loc"), "", ""
        elif kind == "urlset" and len(inside) == 1:  # lastmod isn't when something was published
            yield kind, "entry", _text(node, "loc"), _text(node, "title"), _text(node, "publication_date")
        elif kind in ("rss", "feed", "rdf") and _local(node.tag) in ("item", "entry"):
            href = next((n.get("href") for n in node.iter() if _local(n.tag) == "link" and n.get("href") and n.get("rel", "alternate") == "alternate"), "")
            yield "feed", "entry", _text(node, "link") or href, _text(node, "title"), _text(node, "pubdate", "published", "date", "updated")
        else:
            continue
        held = 0
        if inside:
            inside[-1].remove(node)


def _json_rows(content: bytes) -> list[tuple[str, str, str, str, str]] | None:
    try:
        value = json.loads(content)
    except ValueError:
        return None
    posts = isinstance(value, list)
    rows = value if posts else value.get("items")
    if not isinstance(rows, list):
        return None
    out = []
    for row in rows:
        if not isinstance(row, dict):
            continue
        title = row.get("title") or ""
        title = (title.get("rendered") or title.get("raw") or "") if isinstance(title, dict) else title
        link = row.get("link") if posts else row.get("url") or row.get("external_url")
        date = (row.get("date_gmt") or row.get("date")) if posts else row.get("date_published")
        out.append(("wordpress" if posts else "json-feed", "entry", str(link or ""), str(title), str(date or "")))
    return out


def listing_rows(content: bytes) -> Iterator[tuple[str, str, str, str, str]] | None:
    """(kind, role, link, title, published) of a listing in document order; None for a page or anything else.

    XML is read twice, in chunks: once to see that it is whole, then for its rows; of it, one entry is held at a time. JSON is
    held whole, up to MOST_ENTRY bytes. TooLarge for what goes beyond that, or unpacks to more than MOST_UNPACKED.
    """
    try:
        head = next((chunk.lstrip() for chunk in _unpacked(content) if chunk.strip()), b"")[:1]
        if head in (b"[", b"{"):
            whole = b""
            for chunk in _unpacked(content):
                whole += chunk
                if len(whole) > MOST_ENTRY:
                    raise TooLarge
            rows = _json_rows(whole)
            return None if rows is None else iter(rows)
        if head != b"<":
            return None
        for _ in _xml_rows(_stripped(content)):
            pass
    except TooLarge:
        raise
    except (ValueError, ET.ParseError):
        return None
    return _xml_rows(_stripped(content))


def _stripped(content: bytes) -> Iterator[bytes]:
    """As unpacked, without white space at the beginning, which XML doesn't allow before its declaration."""
    begun = False
    for chunk in _unpacked(content):
        chunk = chunk if begun else chunk.lstrip()
        begun = begun or bool(chunk)
        if chunk:
            yield chunk


def listing_links(content: bytes) -> list[tuple[str, str, str, str, str]] | None:
    """``listing_rows`` as a list."""
    rows = listing_rows(content)
    return None if rows is None else list(rows)


def raw_links(pages: DataFrame) -> DataFrame:
    """Per page (source_id, source_url, url, content) its raw links: kind, role, pos, link, title, published.

    kind is html for pages; role is entry, child (of a sitemap index) or feed. Content may be text or bytes, also gzip.
    A page without links gives one row with a null link, so that it is known to have been read; a listing that is too
    large gives one of kind error and role too_large. A listing's rows leave as they are read, so a page of any
    number of entries is never held.
    """
    schema = f"source_id string, source_url string, url string, {_LINKS}"

    columns = ["source_id", "source_url", "url", "kind", "role", "pos", "link", "title", "published"]

    def found(content: bytes) -> Iterator[tuple]:
        try:
            rows = listing_rows(content)
        except TooLarge:
            yield "error", "too_large", None, "", ""
            return
        if rows is not None:
            empty = True
            for row in rows:
                empty = False
                yield row
            if empty:
                yield "html", "none", None, "", ""
            return
        page = _Page(content.decode("utf-8", "replace"))
        links = [("html", "entry", h, t, "") for h, t in page.anchors] + [("html", "feed", h, "", "") for h in page.feeds]
        yield from links or [("html", "none", None, "", "")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for batch in batches:
            for row in batch.itertuples(index=False):
                content = row.content if isinstance(row.content, bytes) else str(row.content or "").encode()
                for pos, (kind, role, link, title, published) in enumerate(found(content)):
                    try:
                        link = urljoin(row.url, link) if link else link
                    except ValueError:
                        pass
                    out.append((row.source_id, row.source_url, row.url, kind, role, pos, link, title, published))
                    if len(out) == ROWS:
                        yield pd.DataFrame(out, columns=columns)
                        out = []
        yield pd.DataFrame(out, columns=columns)

    rows = pages.select(F.col("source_id").cast("string"), "source_url", "url", "content")
    return rows.mapInPandas(run, schema)


def listing_entries(links: DataFrame, most: int = MOST_ITEMS) -> tuple[DataFrame, DataFrame]:
    """Valid entries and children of listings (canonical, on the source's domain, first seen, at most ``most``), and the others with their problem."""
    listed = links.where("kind <> 'html' and role in ('entry', 'child')").withColumn("canonical_url", canonicalize_url("link"))
    problem = F.when(text_or_empty("link") == "", "missing_link").when(F.col("canonical_url").isNull(), "invalid_url").when(~same_domain("canonical_url", "source_url"), "off_domain")
    judged = ranked(listed.withColumn("problem", problem), ["source_id", "url", "role", "canonical_url", "problem"], [F.col("pos")], "_n")
    judged = judged.withColumn("problem", F.when(F.col("problem").isNull() & (F.col("_n") > 1), "duplicate").otherwise(F.col("problem"))).drop("_n")
    good = ranked(judged.where("problem is null"), ["source_id", "url", "role"], [F.col("pos")], "_n")
    good = good.withColumn("published_at", parse_datetime("published"))
    return good.where(F.col("_n") <= most).drop("_n", "problem"), judged.where("problem is not null").unionByName(good.where(F.col("_n") > most).withColumn("problem", F.lit("over_cap")).select(*judged.columns))


def index_links(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of html pages the article links (same site, first seen, score of 3 or more, 25 at most) and the feeds (same domain, first seen)."""
    html = links.where("kind = 'html' and link is not null").withColumn("canonical_url", canonicalize_url("link")).where("canonical_url is not null")
    scored = html.where((F.col("role") == "entry") & same_site("canonical_url", "url")).withColumn("score", article_score("canonical_url", "title", "url")).where(F.col("score") >= LEAST_SCORE)
    articles = ranked(ranked(scored, ["source_id", "url", "canonical_url"], [F.col("pos")], "_n").where("_n = 1"), ["source_id", "url"], [F.col("pos")], "rank").where(F.col("rank") <= MOST_LINKS)
    feeds = html.where((F.col("role") == "feed") & same_domain("canonical_url", "url"))
    feeds = ranked(feeds, ["source_id", "url", "canonical_url"], [F.col("pos")], "_n").where("_n = 1")
    return articles.select("source_id", "url", "canonical_url", "title", "score", "rank"), feeds.select("source_id", "url", "canonical_url")


def page_dates_of(content: Column, url: Column) -> Column:
    """When a page was published: the first stated date that parses, else its url's own."""

    @F.pandas_udf("array<string>")
    def stated(content: pd.Series) -> pd.Series:
        return content.map(lambda c: page_dates(c.decode("utf-8", "replace") if isinstance(c, bytes) else str(c or "")))

    first = F.get(F.array_compact(F.transform(stated(content), lambda d: parse_datetime(d))), F.lit(0))
    return F.coalesce(first, date_from_url(url).cast("timestamp"))


def publication_dates(pages: DataFrame) -> DataFrame:
    """Url and published_at of pages (url, content): the first stated date that parses, else the url's own."""

    return pages.select("url", page_dates_of(F.col("content"), F.col("url")).alias("published_at"))


def crawl(
    sources: DataFrame,
    pages: DataFrame,
    most_documents: int = MOST_DOCUMENTS,
    most_depth: int = MOST_DEPTH,
    most_items: int = MOST_ITEMS,
    since: str | None = None,
    until: str | None = None,
    scope: Callable[[Column, Column], Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The entries that listings lead to, breadth first, and an error row for each source that met a cap.

    sources: source_id, source_url; pages: url (canonical), content. A level of the search joins the frontier with the
    pages. What a source may still open and take goes from level to level: documents, the source's own page included, are
    opened in the order in which they were met, as long as the source has neither ``most_documents`` of them nor
    ``most_items`` entries, so a level parses at most ``most_documents`` of a source. Nothing is taken from a document that
    isn't opened, and of one that is no more entries or children than the source may still have entries. A document counts once; one that no page answers for counts and is an error. Not opened, and not counted:
    partitions outside ``since`` to ``until`` by their own url, what ``scope`` (source_url, url) says no to, and anything
    deeper than ``most_depth``. Of the entries taken, each url's first counts, unless its stated date lies outside.
    Errors are direct_listing_document_cap_reached where the search ended with documents still waiting, and
    direct_listing_item_cap_reached where it left items of a document, or documents that may have some; fetch_failed for documents
    that no page answers for, and listing_too_large. A source that is listed twice is one.
    """
    frontier = sources.groupBy(F.col("source_id").cast("string").alias("source_id")).agg(F.min("source_url").alias("source_url"))
    frontier = frontier.withColumns({"doc": canonicalize_url("source_url"), "order": F.lit("")})
    quota = frontier.select("source_id", F.lit(most_documents).cast("long").alias("documents"), F.lit(most_items).cast("long").alias("items"))
    seen = found = problems = None
    for depth in range(most_depth + 1):
        waiting = cut(frontier.join(quota, "source_id"))
        if waiting.isEmpty():
            break
        open_ = waiting
        if depth:
            fits = ~outside_window("doc", since, until) if since else F.lit(True)
            fits = fits & scope(F.col("source_url"), F.col("doc")) if scope else fits
            open_ = waiting.where(fits).join(seen, ["source_id", "doc"], "left_anti")
        open_ = ranked(ranked(open_, ["source_id", "doc"], [F.col("order")], "_n").where("_n = 1"), ["source_id"], [F.col("order")], "_n").where(F.col("_n") <= F.col("documents"))
        got = open_.join(pages.select(F.col("url").alias("doc"), "content"), "doc", "left").withColumn("there", F.col("content").isNotNull())
        got = cut(got)
        links = raw_links(got.where("there").select("source_id", "source_url", F.col("doc").alias("url"), "content"))
        links = cut(links.where("role in ('entry', 'child', 'too_large') and kind <> 'html'"))
        huge = links.where("role = 'too_large'").select("source_id", "url", F.lit("listing_too_large").alias("error"))
        good = cut(listing_entries(links, most_items)[0].select("source_id", F.col("url").alias("doc"), "role", "pos", "canonical_url", "title", "published_at"))
        said = links.where("role <> 'too_large'").groupBy("source_id", F.col("url").alias("doc")).agg(F.count(F.lit(1)).alias("said"))

        # Entries before a document, in the order of its source: from where the source has enough, documents stay shut.
        counts = good.where("role = 'entry'").groupBy("source_id", "doc").agg(F.count(F.lit(1)).alias("n"))
        upto = Window.partitionBy("source_id").orderBy("order")
        n = F.coalesce("n", F.lit(0))
        level = got.drop("content").join(counts, ["source_id", "doc"], "left").join(said, ["source_id", "doc"], "left").withColumn("n", n)
        level = level.withColumn("before", F.coalesce(F.sum("n").over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).where("before < items or order = ''")
        level = cut(level)
        taken = ranked(good, ["source_id", "doc", "role"], [F.col("pos")], "_place").join(level.select("source_id", "source_url", "doc", "order", "before", "items"), ["source_id", "doc"])
        taken = taken.withColumn("order", F.concat("order", F.format_string("/%08d", "pos")))
        taken = taken.where("before + _place <= items")
        entries = taken.where("role = 'entry'").select("source_id", "canonical_url", "title", "published_at", F.lit(depth).alias("depth"), "order")
        children = taken.where("role = 'child'").select("source_id", "source_url", F.col("canonical_url").alias("doc"), "order")

        left_out = F.coalesce("said", F.lit(0)) > F.col("items") - F.col("before")
        used = level.groupBy("source_id").agg(F.count(F.lit(1)).alias("_documents"), F.sum("n").alias("_items"), F.max("order").alias("_last"), F.bool_or(left_out).alias("_left_out"))
        after = quota.join(used, "source_id", "left").withColumns({"documents": F.col("documents") - F.coalesce("_documents", F.lit(0)), "items": F.greatest(F.lit(0), F.col("items") - F.coalesce("_items", F.lit(0)))})
        after = cut(after.withColumn("done", (F.col("documents") <= 0) | (F.col("items") <= 0)))
        behind = waiting.select("source_id", "order").join(after.where("done").select("source_id", F.coalesce("_last", F.lit("")).alias("_last")), "source_id").where("order > _last").select("source_id")
        behind = behind.unionByName(children.select("source_id").join(after.where("done").select("source_id"), "source_id")).distinct()
        stopped = after.select("source_id", "items", "_left_out").join(behind.withColumn("_behind", F.lit(True)), "source_id", "left")
        error = F.array_compact(F.array(F.when(F.col("_behind"), "direct_listing_document_cap_reached"), F.when(F.coalesce("_left_out", F.lit(False)) | (F.col("_behind") & (F.col("items") <= 0)), "direct_listing_item_cap_reached")))
        gone = level.where("not there").select("source_id", F.col("doc").alias("url"), F.lit("fetch_failed").alias("error"))
        gone = gone.unionByName(huge).unionByName(stopped.select("source_id", F.lit(None).cast("string").alias("url"), F.explode(error).alias("error")))

        now = level.select("source_id", "doc")
        seen = now if seen is None else seen.unionByName(now)
        found = entries if found is None else found.unionByName(entries)
        problems = gone if problems is None else problems.unionByName(gone)
        quota = after.where("not done").select("source_id", "documents", "items")
        frontier = children
    if found is None:  # no sources
        none = sources.sparkSession.createDataFrame([], "source_id string, canonical_url string, title string, published_at timestamp, depth int")
        return none, none.select("source_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("error"))
    first = ranked(found, ["source_id", "canonical_url"], [F.col("depth"), F.col("order")], "_n").where("_n = 1").drop("_n", "order")
    if since:
        day = F.col("published_at").cast("date")
        first = first.where(day.isNull() | ((day >= F.lit(since).cast("date")) & F.coalesce(day <= F.lit(until).cast("date"), F.lit(True))))
    return first, problems.distinct()


def fallback_entries(answers: DataFrame, coverage: DataFrame, pages: DataFrame, since: str, until: str, most: int = 100) -> DataFrame:
    """Pages that an answer names for sources that nothing else covered: on the source's domain, dated in the window.

    answers: source_id, urls (array); coverage: source_id, source_url, uncovered, incomplete; pages: url (canonical), published_at.
    """
    open_sources = coverage.where("uncovered or incomplete").select("source_id", "source_url")
    named = answers.join(open_sources, "source_id").select("source_id", "source_url", F.posexplode(F.slice("urls", 1, most)).alias("pos", "given")).withColumn("url", canonicalize_url("given"))
    first = ranked(named.where(same_domain("url", "source_url")), ["source_id", "url"], [F.col("pos")], "_n").where("_n = 1")
    dated = first.join(pages.select("url", F.coalesce(F.col("published_at").cast("date"), date_from_url("url")).alias("date")), "url")
    return dated.where(F.col("date").between(F.lit(since).cast("date"), F.lit(until).cast("date"))).select("source_id", "url", "date")


def new_articles(entries: DataFrame, seen: DataFrame, errors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries that weren't seen before, by the hash of their url, of sources that gave no error; and the failed sources.

    entries: source_id, canonical_url; seen: url_hash; errors: source_id, error.
    """
    failed = errors.select("source_id", "error").distinct()
    good = entries.join(failed.select("source_id"), "source_id", "left_anti").withColumn("url_hash", F.sha2("canonical_url", 256))
    fresh = good.join(seen.select("url_hash"), "url_hash", "left_anti")
    return ranked(fresh, ["url_hash"], [F.col("source_id")], "_n").where("_n = 1").drop("_n"), failed
