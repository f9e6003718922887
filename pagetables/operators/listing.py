"""Job offer listings: one row per offer card."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.functions.arrays import built_once, let
from pagetables.functions.dom import Dom
from pagetables.functions.text import (
    last_change_type, offer_id, parse_salary, result_count, str_as_number,
)
from pagetables.functions.urls import drop_query_param, get_query_param, resolve_against, split_url, url_key
from pagetables.schemas import OFFER_SIMPLE
from pagetables.spec import ADDED_PHRASE, SiteSpec


def listing_entries(dom: Dom, page_url: Column, base: Column, spec: SiteSpec,
                    keep_base_query: bool = False) -> Column:
    """Offer cards of one page as ``array<struct>`` in page order, promoted cards left out.

    ``base`` is the page's ``split_url``, against which links are resolved.
    """
    css = spec.listing
    of_a_card = [css[k] for k in ("link", "footer", "salary", "change_time", "employer", "logo_link", "logo", "location", "label")]
    return dom.scoped(of_a_card, lambda d: _entries_of(d, page_url, base, spec, keep_base_query))


def _entries_of(dom: Dom, page_url: Column, base: Column, spec: SiteSpec, keep_base_query: bool) -> Column:
    css = spec.listing

    def link(node: Column, attr: str) -> Column:
        return resolve_against(base, dom.attr(node, attr), keep_base_query)

    def entry(card: Column) -> Column:
        def first(name: str) -> Column:
            return dom.find(css[name], among=card)

        parts = F.struct(first("link").alias("link"), first("footer").alias("footer"))
        return let(parts, lambda p: let(
            F.struct(
                link(p["link"], "href").alias("url"),
                parse_salary(dom.text(first("salary"))).alias("pay"),
                dom.find(css["change_time"], p["footer"]).alias("changed"),
            ),
            lambda q: F.struct(
                page_url.alias("listingUrl"),
                dom.text(first("employer")).alias("employerName"),
                link(first("logo_link"), "href").alias("employerUrl"),
                link(first("logo"), "src").alias("employerLogoUrl"),
                dom.text(p["link"]).alias("offerName"),
                q["url"].alias("offerUrl"),
                offer_id(q["url"]).alias("offerId"),
                dom.text(first("location")).alias("location"),
                dom.texts(dom.find_all(css["label"], among=card)).alias("labels"),
                dom.text(q["changed"]).alias("lastChangeRelativeTime"),
                last_change_type(
                    dom.text(p["footer"], without=F.array(q["changed"])), ADDED_PHRASE
                ).alias("lastChangeType"),
                *[q["pay"][f].alias(f) for f in (
                    "salaryRange", "salaryRangeLower", "salaryRangeUpper",
                    "salaryCurrency", "salaryPeriod")],
            ),
        ))

    cards = F.transform(dom.find_all(css["row"]), lambda row: dom.inside(row))
    return F.transform(cards, entry)


def page_number(url: Column) -> Column:
    """Listing page number in a URL; 1 when missing, NULL when not a number."""
    raw = get_query_param(url, "page_num")
    return F.when(raw.isNull(), F.lit(1).cast("bigint")).otherwise(str_as_number(raw, "int"))


def listing_key(url: Column) -> Column:
    """What pages of one listing share: the canonical URL without the page number."""
    return url_key(F.coalesce(drop_query_param(url, "page_num"), url))


@built_once
def _entries(spec: SiteSpec, keep_base_query: bool) -> Column:
    return listing_entries(
        Dom("nodes"), F.col("effective_url"), F.col("_base"), spec, keep_base_query
    )


@built_once
def _counter(spec: SiteSpec) -> Column:
    dom = Dom("nodes")
    return result_count(dom.text(dom.find(spec.listing["counter"])))


@built_once
def _listing() -> Column:
    """A page whose number can't be read is a listing of its own, lest it take the first page's place."""
    url = F.col("effective_url")
    known = F.col("page.list_page_num").isNotNull() | page_number(url).isNotNull()
    return F.when(known, listing_key(url)).otherwise(url_key(url))


@built_once
def _page_num() -> Column:
    given = F.col("page.list_page_num").cast("bigint")
    return F.coalesce(given, page_number(F.col("effective_url")), F.lit(1))


def page_key() -> Column:
    """A listing and its page number, known from the URL and the request alone."""
    return F.struct(_listing().alias("listing"), _page_num().alias("page_num"))


def listing_pages(shredded: DataFrame, spec: SiteSpec, keep_base_query: bool = False) -> DataFrame:
    """One compact row per listing page: key, number, result count and entries.

    No shuffle: everything is read from the page's own row. The DOM is dropped
    here, so later shuffles carry entries only.
    """
    return (
        shredded.filter(F.col("route") == "jobListing")
        .withColumn("_base", split_url(F.col("effective_url")))
        .withColumns({
            "entries": _entries(spec, keep_base_query),
            "counter": _counter(spec),
            "listing": _listing(),
            "page_num": _page_num(),
        })
        .withColumns({"empty": F.size("entries") == 0, "n": F.size("entries")})
        .drop("nodes", "_base")
    )


def explode_entries(pages: DataFrame) -> DataFrame:
    """Page rows -> offer rows, with the position in the page as ``pos``."""
    keep = [c for c in pages.columns if c not in ("entries", "counter", "empty", "n")]
    return explode_once(pages, keep).select(
        *keep, "pos", *[F.col("entry")[f.name].alias(f.name) for f in OFFER_SIMPLE]
    )


def explode_once(pages: DataFrame, keep: list[str]) -> DataFrame:
    """(keep, pos, entry). For a plain explode Spark adds a filter on the array's size, moves it below the projection and so extracts all entries twice."""
    return pages.select(*keep, F.posexplode_outer("entries").alias("pos", "entry")).filter(F.col("pos").isNotNull())


def result_totals(pages: DataFrame) -> DataFrame:
    """Count-only mode: results announced per listing, the largest of its pages."""
    return (
        pages.filter(F.col("counter").isNotNull())
        .groupBy("listing")
        .agg(F.max("counter.total").alias("total"))
    )
