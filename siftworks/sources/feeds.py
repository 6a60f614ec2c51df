"""Feeds as parsers: payload text in, posting rows out.

A JSON feed is a declaration: where its entries are, and for each posting field
an expression over an entry.  Payloads are rows ``source_ord, source, company,
token, page, payload``; the result has the pivot columns, the position of the
entry, and a second frame tells what was wrong with payloads and entries.

Scalars are read as text.  Entries without an id or a title are dropped and
counted; a payload of the wrong shape is an error of its source.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from siftworks.functions import dates as D
from siftworks.functions import text as T
from siftworks.functions.text import ENTITY, XML_ENTITIES  # values, so that workers need no package

PIVOT = ("id", "source", "company", "title", "location", "remote_type", "url", "date", "description")


class Entry:
    """One feed entry: JSON text with path access."""

    def __init__(self, json: Column, company: Column, token: Column):
        self.json, self.company, self.token = json, company, token

    def raw(self, path: str) -> Column:
        return F.get_json_object(self.json, f"$.{path}")

    def text(self, path: str) -> Column:
        return T.strip(self.raw(path))

    def texts(self, path: str) -> Column:
        return F.coalesce(F.from_json(self.raw(path), "array<string>"), F.array().cast("array<string>"))

    def true(self, path: str) -> Column:
        return F.coalesce(self.raw(path) == "true", F.lit(False))

    def has(self, path: str, key: str) -> Column:
        return F.coalesce(F.array_contains(F.json_object_keys(self.raw(path)), key), F.lit(False))

    def date(self, *paths: str) -> Column:
        found = [F.nullif(D.to_iso_utc(self.raw(p)), F.lit("")) for p in paths]
        return F.coalesce(*found, F.lit(""))

    def html(self, path: str) -> Column:
        return T.html_to_text(self.text(path))


@dataclass(frozen=True)
class Feed:
    """``entries``: JSON path of the list, ``$`` for a bare array.
    ``aggregator``: rows without a company are dropped."""

    entries: str
    fields: Callable[[Entry], dict[str, Column]]
    keep: Callable[[Entry], Column] | None = None
    aggregator: bool = False


def joined(*blocks: Column, separator: str = "\n\n") -> Column:
    return F.array_join(F.filter(F.array(*blocks), lambda b: b != ""), separator)


def filled(*cs: Column) -> Column:
    """The first non-empty of already clean columns."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cs], F.lit(""))


def greenhouse(e: Entry) -> dict[str, Column]:
    place = e.text("location.name")
    url = filled(e.text("absolute_url"), F.concat(F.lit("https://boards.greenhouse.io/"), e.token, F.lit("/jobs/"), e.text("id")))
    return {"id": e.text("id"), "company": e.company, "title": e.text("title"), "location": place, "remote_type": T.infer_work_mode(place), "url": url, "date": e.date("first_published", "updated_at"), "description": e.html("content")}


def lever(e: Entry) -> dict[str, Column]:
    place = filled(T.join_distinct(e.texts("categories.allLocations")), e.text("categories.location"))
    sections = F.coalesce(F.from_json(e.raw("lists"), "array<struct<text:string,content:string>>"), F.array().cast("array<struct<text:string,content:string>>"))
    # one HTML parse of all sections: a separator keeps them apart
    bodies = F.split(T.html_to_text(F.array_join(F.transform(sections, lambda s: T.text(s["content"])), "<p>\x1e</p>")), "\x1e")
    parts = F.zip_with(sections, bodies, lambda s, b: F.array_join(F.filter(F.array(T.strip(s["text"]), T.strip(b)), lambda x: x != ""), "\n"))
    listed = F.array_join(F.filter(parts, lambda p: p != ""), "\n\n")
    intro = filled(e.text("descriptionPlain"), e.html("description"))
    more = filled(e.text("additionalPlain"), e.html("additional"))
    body = T.strip(F.replace(joined(intro, listed, more), F.lit("\xa0"), F.lit(" ")))
    return {"id": e.text("id"), "company": e.company, "title": e.text("text"), "location": place, "remote_type": T.normalise_work_mode(e.raw("workplaceType"), T.infer_work_mode(place)), "url": filled(e.text("hostedUrl"), e.text("applyUrl")), "date": e.date("createdAt"), "description": body}


def ashby(e: Entry) -> dict[str, Column]:
    more = F.transform(F.coalesce(F.from_json(e.raw("secondaryLocations"), "array<struct<location:string>>"), F.array().cast("array<struct<location:string>>")), lambda s: s["location"])
    place = T.join_distinct(F.concat(F.array(e.text("location")), more))
    fallback = F.when(e.true("isRemote"), F.lit(T.REMOTE)).otherwise(T.infer_work_mode(place))
    return {"id": e.text("id"), "company": e.company, "title": e.text("title"), "location": place, "remote_type": T.normalise_work_mode(e.raw("workplaceType"), fallback), "url": filled(e.text("jobUrl"), e.text("applyUrl")), "date": e.date("publishedAt"), "description": filled(e.text("descriptionPlain"), e.html("descriptionHtml"))}


def smartrecruiters(e: Entry) -> dict[str, Column]:
    spelled = T.join_distinct(F.array(e.text("location.city"), e.text("location.region"), F.upper(e.text("location.country"))))
    mode = F.when(e.true("location.remote"), T.REMOTE).when(e.true("location.hybrid"), T.HYBRID).when(e.has("location", "remote"), T.ONSITE).otherwise(T.UNKNOWN)
    return {"id": e.text("id"), "company": e.company, "title": e.text("name"), "location": filled(e.text("location.fullLocation"), spelled), "remote_type": mode, "url": F.concat(F.lit("https://jobs.smartrecruiters.com/"), e.token, F.lit("/"), e.text("id")), "date": e.date("releasedDate"), "description": F.lit("")}


def workable(e: Entry) -> dict[str, Column]:
    shape = "struct<city:string,region:string,country:string,hidden:boolean>"

    def spelled(p: Column) -> Column:
        return F.array_join(F.filter(F.array(*[T.strip(p[k]) for k in ("city", "region", "country")]), lambda x: x != ""), ", ")

    several = F.from_json(e.raw("locations"), f"array<{shape}>")
    places = F.when(F.coalesce(F.size(several), F.lit(0)) > 0, several).otherwise(F.array_compact(F.array(F.from_json(e.raw("location"), shape))))
    place = T.join_distinct(F.transform(F.filter(places, lambda p: ~F.coalesce(p["hidden"], F.lit(False))), spelled))
    fallback = F.when(e.true("remote"), F.lit(T.REMOTE)).otherwise(T.infer_work_mode(place))
    code = e.text("shortcode")
    url = F.concat(F.lit("https://apply.workable.com/"), e.token, F.lit("/"), F.when(code == "", F.lit("")).otherwise(F.concat(F.lit("j/"), code, F.lit("/"))))
    return {"id": e.text("id"), "company": e.company, "title": e.text("title"), "location": place, "remote_type": T.normalise_work_mode(e.raw("workplace"), fallback), "url": url, "date": e.date("published"), "description": F.lit("")}


def remoteok(e: Entry) -> dict[str, Column]:
    place = F.btrim(e.text("location"), F.lit(" ,"))
    return {"id": e.text("id"), "company": e.text("company"), "title": e.text("position"), "location": place, "remote_type": T.infer_work_mode(place, T.REMOTE), "url": filled(e.text("url"), e.text("apply_url")), "date": e.date("date", "epoch"), "description": T.repair_mojibake(e.html("description"))}


def remotive(e: Entry) -> dict[str, Column]:
    return {"id": e.text("id"), "company": e.text("company_name"), "title": e.text("title"), "location": e.text("candidate_required_location"), "remote_type": F.lit(T.REMOTE), "url": e.text("url"), "date": e.date("publication_date"), "description": e.html("description")}


def himalayas(e: Entry) -> dict[str, Column]:
    guid = e.text("guid")
    return {"id": T.last_segment(guid), "company": e.text("companyName"), "title": e.text("title"), "location": T.join_distinct(e.texts("locationRestrictions")), "remote_type": F.lit(T.REMOTE), "url": filled(guid, e.text("applicationLink")), "date": e.date("pubDate"), "description": filled(e.html("description"), e.text("excerpt"))}


def workingnomads(e: Entry) -> dict[str, Column]:
    place, url = e.text("location"), e.text("url")
    return {"id": F.regexp_extract(url, r"/job/go/(\d+)", 1), "company": e.text("company_name"), "title": e.text("title"), "location": place, "remote_type": T.infer_work_mode(place, T.REMOTE), "url": url, "date": e.date("pub_date"), "description": e.html("description")}


def landingjobs(e: Entry) -> dict[str, Column]:
    shape = "array<struct<city:string,country_code:string>>"
    places = F.transform(F.coalesce(F.from_json(e.raw("locations"), shape), F.array().cast(shape)), lambda p: F.array_join(F.filter(F.array(T.strip(p["city"]), T.strip(p["country_code"])), lambda x: x != ""), ", "))
    place, url = T.join_distinct(places), e.text("url")
    mode = F.when(e.true("remote"), F.lit(T.REMOTE)).otherwise(T.infer_work_mode(place))
    return {"id": e.text("id"), "company": T.company_of_path(url), "title": e.text("title"), "location": place, "remote_type": mode, "url": url, "date": e.date("published_at"), "description": joined(*[e.html(k) for k in ("role_description", "main_requirements", "nice_to_have")])}


def freework(e: Entry) -> dict[str, Column]:
    mode = F.lower(e.text("remoteMode"))
    known = F.when(mode == "full", T.REMOTE).when(mode == "partial", T.HYBRID).when(mode == "none", T.ONSITE).otherwise(T.UNKNOWN)
    job, own = e.text("job.slug"), e.text("slug")
    way = F.when(job == "", F.lit("jobs/")).otherwise(F.concat(job, F.lit("/job-mission/")))
    url = F.when(own == "", F.lit("")).otherwise(F.concat(F.lit("https://www.free-work.com/fr/tech-it/"), way, own))
    return {"id": e.text("id"), "company": e.text("company.name"), "title": e.text("title"), "location": e.text("location.label"), "remote_type": known, "url": url, "date": e.date("publishedAt"), "description": e.html("description")}


def apec(e: Entry) -> dict[str, Column]:
    number, place = e.text("numeroOffre"), e.text("lieuTexte")
    url = F.when(number == "", F.lit("")).otherwise(F.concat(F.lit("https://www.apec.fr/candidat/recherche-emploi.html/emploi/detail-offre/"), number))
    return {"id": filled(number, e.text("id")), "company": e.text("nomCommercial"), "title": e.text("intitule"), "location": place, "remote_type": T.infer_work_mode(place), "url": url, "date": e.date("datePublication", "dateValidation"), "description": e.html("texteOffre")}


def hackernews(e: Entry) -> dict[str, Column]:
    body = e.html("text")
    first = F.substring_index(body, "\n", 1)
    parts = T.headline(first)
    # a comment without a headline title still counts if it has text
    return {"id": e.text("id"), "company": parts["company"], "title": parts["title"], "location": parts["location"], "remote_type": T.infer_work_mode(first), "url": F.concat(F.lit("https://news.ycombinator.com/item?id="), e.text("id")), "date": e.date("created_at"), "description": body}


JSON_FEEDS: dict[str, Feed] = {
    "greenhouse": Feed("$.jobs", greenhouse),
    "lever": Feed("$", lever),
    "ashby": Feed("$.jobs", ashby),
    "smartrecruiters": Feed("$.content", smartrecruiters),
    "workable": Feed("$.results", workable),
    "remoteok": Feed("$", remoteok, keep=lambda e: ~(F.array_contains(F.json_object_keys(e.json), "legal") & ~F.array_contains(F.json_object_keys(e.json), "position")), aggregator=True),
    "remotive": Feed("$.jobs", remotive, aggregator=True),
    "himalayas": Feed("$.jobs", himalayas, aggregator=True),
    "workingnomads": Feed("$", workingnomads, aggregator=True),
    "landingjobs": Feed("$", landingjobs, aggregator=True),
    "freework": Feed("$['hydra:member']", freework, aggregator=True),
    "apec": Feed("$.resultats", apec, aggregator=True),
    "hackernews": Feed("$.children", hackernews, aggregator=True),
}


def hiring_thread(stories: Column) -> Column:
    """Id of the first story in feed order that asks who is hiring."""
    hits = F.from_json(F.get_json_object(stories, "$.hits"), "array<struct<objectID:string,title:string>>")
    asks = F.filter(hits, lambda h: F.startswith(F.lower(T.strip(h["title"])), F.lit("ask hn: who is hiring?")))
    return F.get(asks, F.lit(0))["objectID"]


def entries_of(payloads: DataFrame, feed: Feed) -> DataFrame:
    """source columns, page, entry_ord, entry (JSON text); ``__there`` is false
    for a payload of the wrong shape, which keeps one row; an empty list has none."""
    listed = F.from_json(F.get_json_object("payload", feed.entries), "array<string>")
    rows = payloads.withColumn("__listed", listed).where(F.col("__listed").isNull() | (F.size("__listed") > 0))
    return rows.select("source_ord", "source", "company", "token", "page", F.col("__listed").isNotNull().alias("__there"), F.posexplode_outer("__listed").alias("entry_ord", "entry"))


def parse_json_feed(payloads: DataFrame, name: str) -> DataFrame:
    """Posting rows of one feed, with ``problem`` (null where fine): shape (of
    the payload), entry (no object), missing (id or title), company (an
    aggregator's row without one).  Consumers keep the rows without a problem."""
    feed = JSON_FEEDS[name]
    rows = entries_of(payloads, feed)
    e = Entry(F.col("entry"), F.col("company"), F.col("token"))
    object_ = F.startswith(F.ltrim(F.col("entry")), F.lit("{"))
    if feed.keep is not None:
        rows = rows.where(~object_ | F.coalesce(feed.keep(e), F.lit(True)) | F.col("entry").isNull())
    made = feed.fields(e)
    rows = rows.select("source_ord", "page", "entry_ord", F.lit(name).alias("source"), F.coalesce(object_, F.lit(False)).alias("__object"), "__there", *[made[c].alias(c) for c in PIVOT if c != "source"])
    named = F.col("description") if name == "hackernews" else F.col("title")
    problem = (
        F.when(~F.col("__there"), F.lit("shape"))
        .when(~F.col("__object"), F.lit("entry"))
        .when((F.col("id") == "") | (named == ""), F.lit("missing"))
        .when(F.lit(feed.aggregator) & (F.col("company") == ""), F.lit("company"))
    )
    return rows.withColumn("problem", problem).drop("__object", "__there")


# types and not DDL: a module must load before there is a session
RSS_ITEM = ArrayType(StructType([*(StructField(n, StringType()) for n in ("title", "link", "guid", "description", "content", "pubDate")), StructField("extras", MapType(StringType(), StringType()))]))


@pandas_udf(RSS_ITEM)
def rss_items(s: pd.Series) -> pd.Series:
    """Items of an RSS document, by local names, first non-empty text wins;
    null where it is no XML."""
    import re
    from html.entities import html5
    from xml.etree import ElementTree

    own = {"title": "title", "link": "link", "guid": "guid", "description": "description", "encoded": "content", "pubDate": "pubDate"}

    def one(xml):
        try:
            root = ElementTree.fromstring(re.sub(ENTITY, lambda m: m[0] if m[1] in XML_ENTITIES else html5.get(f"{m[1]};", m[0]), xml or ""))
        except ElementTree.ParseError:
            return None
        top = root.find("channel")
        out = []
        for item in (root if top is None else top).findall("item"):
            seen: dict[str, str] = {}
            for el in item:
                if value := (el.text or "").strip():
                    seen.setdefault(el.tag.rpartition("}")[2], value)
            row = {to: seen.pop(tag, "") for tag, to in own.items()}
            out.append(row | {"extras": seen})
        return out

    return s.map(one)


def rss_fields(name: str, item: Column) -> dict[str, Column]:
    """Posting fields of one RSS item of a feed."""
    title, extra = T.strip(item["title"]), lambda k: T.strip(F.try_element_at(item["extras"], F.lit(k)))
    link = filled(T.text(item["link"]), T.text(item["guid"]))
    company, place, mode, ident = F.lit(""), F.lit(""), F.lit(T.REMOTE), T.last_segment(link)
    if name == "weworkremotely":
        cut = F.locate(": ", title)
        split_ = (cut > 0) & (F.substr(title, cut + 2) != "")
        company = F.when(split_, T.strip(F.substr(title, F.lit(1), cut - 1))).otherwise("")
        title = F.when(split_, T.strip(F.substr(title, cut + 2))).otherwise(title)
        place = extra("region")
    elif name == "nodesk":
        at = r"(?s)^(.*) at (.*)$"
        company = T.strip(F.regexp_extract(title, at, 2))
        title = F.when(title.rlike(at), T.strip(F.regexp_extract(title, at, 1))).otherwise(title)
    else:
        company, place = extra("company"), extra("location")
        mode = T.infer_work_mode(place)
        ident = filled(extra("post-id"), ident)
    body = T.html_to_text(filled(T.text(item["content"]), T.text(item["description"])))
    return {"id": ident, "company": company, "title": title, "location": place, "remote_type": mode, "url": link, "date": D.to_iso_utc(item["pubDate"]), "description": body}


RSS_FEEDS = ("weworkremotely", "nodesk", "jobspresso", "euremotejobs")


def parse_rss_feed(payloads: DataFrame, name: str) -> DataFrame:
    """Posting rows of an RSS feed, as :func:`parse_json_feed` gives them."""
    rows = payloads.withColumn("__items", rss_items("payload")).where(F.col("__items").isNull() | (F.size("__items") > 0))
    rows = rows.select("source_ord", "page", F.posexplode_outer("__items").alias("entry_ord", "item"))
    made = rss_fields(name, F.col("item"))
    rows = rows.select("source_ord", "page", "entry_ord", F.lit(name).alias("source"), F.col("item").isNull().alias("__none"), *[made[c].alias(c) for c in PIVOT if c != "source"])
    problem = F.when(F.col("__none"), F.lit("shape")).when((F.col("title") == "") | (F.col("url") == ""), F.lit("missing")).when(F.col("company") == "", F.lit("company"))
    return rows.withColumn("problem", problem).drop("__none")


def parse(payloads: DataFrame, name: str) -> DataFrame:
    """Rows of any feed by name; an unknown name is an error."""
    if name in JSON_FEEDS:
        return parse_json_feed(payloads, name)
    if name in RSS_FEEDS:
        return parse_rss_feed(payloads, name)
    raise ValueError(f"no parser for the feed {name!r}")


def health(registry: DataFrame, parsed: DataFrame) -> DataFrame:
    """state and rows of every registered source: ok, empty or failed."""
    got = parsed.groupBy("source_ord").agg(
        F.count_if(F.col("problem").isNull()).alias("n_rows"),
        F.count_if(F.col("problem") == "shape").alias("n_errors"),
        F.count_if(F.col("problem").isin("entry", "missing", "company")).alias("n_dropped"),
    )
    n = F.coalesce("n_rows", F.lit(0))
    state = F.when(F.coalesce("n_errors", F.lit(0)) > 0, "failed").when(n > 0, "ok").otherwise("empty")
    return registry.join(got, "source_ord", "left").select(*registry.columns, n.alias("n_rows"), F.coalesce("n_dropped", F.lit(0)).alias("n_dropped"), state.alias("state"))


def run_totals(states: DataFrame) -> DataFrame:
    """One row: n_ok, n_empty, n_failed, and all_failed (there were sources and
    none of them answered)."""
    n = lambda state: F.count_if(F.col("state") == state)
    return states.agg(
        n("ok").alias("n_ok"), n("empty").alias("n_empty"), n("failed").alias("n_failed"),
        ((F.count("*") > 0) & (n("failed") == F.count("*"))).alias("all_failed"),
    )
