"""Job pages with schema.org data, sitemaps, and posting rows from them."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from siftworks.functions import dates as D
from siftworks.functions import text as T
from siftworks.session import ship_package

# Fixed value: where pages keep linked data.
LINKED_DATA = r"(?is)<script[^>]+type\s*=\s*['\"]application/ld\+json['\"][^>]*>(.*?)</script>"
POSTING = StructType([StructField(n, StringType()) for n in ("ident", "company", "title", "place", "mode", "url", "posted", "contract", "body")])


def linked_blocks(html: Column) -> Column:
    """All linked-data scripts of a page, in order (JVM only)."""
    return F.regexp_extract_all(T.text(html), F.lit(LINKED_DATA), F.lit(1))


@pandas_udf(POSTING)
def first_posting(blocks: pd.Series) -> pd.DataFrame:
    """Fields of the first posting in a page's blocks; broken JSON is passed
    over; nulls where there is none.  Blocks are of any shape, hence Python."""
    import json

    from siftworks.sources.linked_data import clean, contract, find_posting, identifier, organisation, places

    def one(texts):
        for t in texts if texts is not None else ():
            try:
                node = find_posting(json.loads(t.strip()))
            except ValueError:
                continue
            if node is not None:
                posted = node.get("datePosted")
                return (
                    identifier(node.get("identifier")),
                    organisation(node.get("hiringOrganization")),
                    clean(node.get("title")),
                    ", ".join(dict.fromkeys(places(node.get("jobLocation")))),
                    clean(node.get("jobLocationType")).upper(),
                    clean(node.get("url")),
                    "" if posted is None or isinstance(posted, bool) else str(posted),
                    contract(node.get("employmentType")),
                    clean(node.get("description")),
                )
        return (None,) * 9

    return pd.DataFrame([one(b) for b in blocks], columns=["ident", "company", "title", "place", "mode", "url", "posted", "contract", "body"])


def parse_pages(pages: DataFrame, source: str, *, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Posting rows of job pages (url, html); pages without a posting give
    none, nor do postings without a company.

    The id falls back on the URL's last segment, the work mode on what location
    and title hint at.  Pages without a linked-data script never reach Python.
    """
    ship_package(pages.sparkSession)
    rows = pages.select(T.text(F.col(url_col)).alias("__loc"), linked_blocks(F.col(html_col)).alias("__blocks")).where(F.size("__blocks") > 0)
    rows = rows.withColumn("__p", first_posting("__blocks")).where(F.col("__p.title").isNotNull() & (F.col("__p.company") != ""))
    p = F.col("__p")
    url = F.when(p["url"] != "", p["url"]).otherwise(F.col("__loc"))
    mode = F.when(p["mode"] == "TELECOMMUTE", F.lit(T.REMOTE)).otherwise(T.infer_work_mode(F.concat_ws(" ", p["place"], p["title"])))
    body = T.html_to_text(p["body"])
    return rows.select(
        F.when(p["ident"] != "", p["ident"]).otherwise(T.last_segment(url)).alias("id"),
        F.lit(source).alias("source"),
        p["company"].alias("company"),
        p["title"].alias("title"),
        p["place"].alias("location"),
        mode.alias("remote_type"),
        url.alias("url"),
        D.to_iso_utc(p["posted"]).alias("date"),
        T.strip(F.when(p["contract"] != "", F.concat(p["contract"], F.lit("\n\n"), body)).otherwise(body)).alias("description"),
    )


SITEMAP = StructType([StructField("urls", ArrayType(StructType([StructField("loc", StringType()), StructField("lastmod", StringType())]))), StructField("children", ArrayType(StringType())), StructField("problem", StringType())])


def sitemap(raw: bytes | None) -> tuple[list[tuple[str, str]], list[str]]:
    """A sitemap file (gzipped or not): its URLs with their dates as written,
    or, for an index, its children.  What cannot be read is a ValueError, never
    an empty sitemap: that would make all known URLs unknown."""
    import gzip
    import zlib
    from xml.etree import ElementTree

    try:
        data = raw or b""
        root = ElementTree.fromstring(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data)
    except (ElementTree.ParseError, OSError, EOFError, zlib.error) as e:
        raise ValueError(f"unreadable sitemap: {e}") from e
    local = lambda el: el.tag.rpartition("}")[2]
    index = local(root) == "sitemapindex"
    entries = [[(local(c), (c.text or "").strip()) for c in el] for el in root if local(el) == ("sitemap" if index else "url")]
    if index:
        firsts = (next((text for name, text in e if name == "loc" and text), "") for e in entries)
        return [], list(filter(None, firsts))
    return [(f["loc"], f.get("lastmod", "")) for f in map(dict, entries) if f.get("loc")], []


@pandas_udf(SITEMAP)
def read_sitemap(content: pd.Series) -> pd.DataFrame:
    """:func:`sitemap` of a column; ``problem`` says what is wrong with a file,
    whose lists are null then."""

    def one(raw):
        try:
            urls, children = sitemap(raw)
        except ValueError as e:
            return None, None, str(e)
        return [{"loc": loc, "lastmod": at} for loc, at in urls], children, None

    return pd.DataFrame([one(r) for r in content], columns=["urls", "children", "problem"])


def sitemap_entries(files: DataFrame, *, content_col: str = "content") -> DataFrame:
    """pos, loc, lastmod (normalised, empty if undated) and problem of sitemap
    files, e.g. from ``spark.read.format("binaryFile")``; other columns are
    carried.  An unreadable file is one row with its problem and no entry; a
    crawl must stop there (:func:`readable`)."""
    keep = [c for c in files.columns if c != content_col]
    rows = files.withColumn("__s", read_sitemap(content_col)).where("__s.problem IS NOT NULL OR size(__s.urls) > 0")
    rows = rows.select(*keep, "__s.problem", F.posexplode_outer("__s.urls").alias("pos", "__u"))
    lastmod = F.when(F.col("__u").isNotNull(), D.to_iso_utc(F.col("__u.lastmod")))
    return rows.select(*keep, "pos", F.col("__u.loc").alias("loc"), lastmod.alias("lastmod"), "problem")


def readable(entries: DataFrame) -> DataFrame:
    """Entries without the column ``problem``; the first problem, if any, is an
    error when the rows are read, so nothing is stored from half a sitemap."""
    wrong = F.col("problem").isNotNull()
    return entries.where(F.when(wrong, F.raise_error(F.col("problem")).isNull()).otherwise(F.lit(True))).drop("problem")


def walk_sitemaps(fetch, roots: list[str], cap: int = 25) -> list[str]:
    """Breadth-first walk of sitemap indexes on the driver: ``fetch(url)`` gives
    (urls, children); at most ``cap`` files, none twice.  Returns the URLs of
    the leaf sitemaps, in order."""
    queue, seen, leaves = list(roots), set(), []
    while queue and len(seen) < cap:
        url = queue.pop(0)
        if url in seen:
            continue
        seen.add(url)
        urls, children = fetch(url)
        leaves += [url] * bool(urls)
        queue += [c for c in children if c not in seen]
    return leaves
