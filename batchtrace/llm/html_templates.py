"""Main text of web pages by site template removal.

Pass 1 hashes every element subtree that holds text and counts, per host, the
distinct pages it occurs on (partial counts before the shuffle; host and hash
together are the key, so a hot host is spread over its hashes). Pages are
distinct by their text, so copies of one article under other page ids count once.
Inside an article or main part only boxes made of links are counted, never prose.
A box (an element that holds blocks, a list, a table) is template from
``box_pages`` pages on, however large its host is; any other subtree on at least
``share`` of the host's distinct pages, and on ``least_pages`` at least, as is a box.

Pass 2 extracts each page's text without template subtrees and without menus,
headers, footers, sidebars, notices, adverts, forms, scripts and comments. While
there are at most ``LOOKUP`` templates in all, the tasks look them up by host;
beyond, subtrees are joined to them on (host, hash) and each page gets its own,
so no row holds the templates of a host.

Results: null html is empty and gives ''. Pages that repeat, or have the same text, count once for the
templates; each still gives its row. A null or hostless url belongs to no site,
so nothing recurs for it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchtrace.llm.common import chunks, stored
from batchtrace.llm.html_page import content, main_text

SHARE, LEAST_PAGES, BOX_PAGES = 0.5, 5, 20
#: Templates that may be sent to every task.
LOOKUP = 100_000


def host(url: Column) -> Column:
    """Host in lower case; '' if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def page_trees(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host, page, body, boxes, others``: hashes of each page, its text and its subtrees that may be template."""
    kept = pages.select(host(F.col(url_col)).alias("host"), F.xxhash64(html_col).alias("page"),
                        F.col(html_col).alias("html")).filter((F.col("host") != "") & F.col("html").isNotNull())

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "html"):
            bodies, boxes, others = [], [], []
            for h in b.column(2).to_pylist():
                text, trees = content(h)
                bodies.append(xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63))
                boxes.append(sorted(t for t, box in trees.items() if box))
                others.append(sorted(t for t, box in trees.items() if not box))
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (boxes, others)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(bodies, pa.int64()), *lists],
                                             ["host", "page", "body", "boxes", "others"])

    return kept.mapInArrow(hashes, "host string, page long, body long, boxes array<long>, others array<long>")


def templates(seen: DataFrame, share: float = SHARE, least_pages: int = LEAST_PAGES, box_pages: int = BOX_PAGES) -> DataFrame:
    """``host, tree``: hashes of each site's template subtrees, from ``page_trees``."""
    either = [seen.select("host", "body", F.explode(c).alias("tree"), F.lit(c == "boxes").alias("box")) for c in ("boxes", "others")]
    times = either[0].unionAll(either[1]).distinct().groupBy("host", "tree") \
        .agg(F.count(F.lit(1)).alias("n"), F.max("box").alias("box")).filter(F.col("n") >= min(least_pages, box_pages))
    counts = seen.select("host", "body").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("n_pages"))
    often = (F.col("n") >= least_pages) & (F.col("n") >= F.col("n_pages") * F.lit(share))
    return times.join(counts, "host").filter(often | (F.col("box") & (F.col("n") >= box_pages))).select("host", "tree")


def extract(pages: DataFrame, share: float = SHARE, least_pages: int = LEAST_PAGES, id_col: str = "page_id",
            url_col: str = "url", html_col: str = "html", box_pages: int = BOX_PAGES, lookup: int = LOOKUP) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    seen = stored(page_trees(pages, url_col, html_col), "subtrees")
    found = stored(templates(seen, share, least_pages, box_pages), "templates")
    kept = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"), host(F.col(url_col)).alias("site"))
    few = found.count() <= lookup
    by_host: dict[str, set[int]] = {}
    if few:
        for r in found.toLocalIterator():
            by_host.setdefault(r["host"], set()).add(r["tree"])
        kept = kept.withColumn("template", F.lit(None).cast("array<long>"))
    else:
        # few different pages share a key, so a hot host is spread over its pages
        trees = seen.select("host", "page", F.explode(F.concat("boxes", "others")).alias("tree")).distinct()
        own = trees.join(found, ["host", "tree"]).groupBy("host", "page").agg(F.collect_list("tree").alias("template"))
        kept = kept.join(own, (F.col("site") == F.col("host")) & (F.xxhash64("html") == F.col("page")), "left") \
            .select("page_id", "url", "html", "site", "template")
    sent = pages.sparkSession.sparkContext.broadcast(by_host)

    def text_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "html"):
            texts = [main_text(page, frozenset(own) if own is not None else sent.value.get(site, frozenset()))
                     for page, site, own in zip(*(b.column(i).to_pylist() for i in (2, 3, 4)), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())],
                                             ["page_id", "url", "text"])

    kind = kept.schema["page_id"].dataType.simpleString()
    return kept.mapInArrow(text_of, f"page_id {kind}, url string, text string") \
        .withColumn("n_chars", F.length("text").cast("long"))
