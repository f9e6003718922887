"""Routing: which extractor a page belongs to."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.functions.arrays import built_once
from pagetables.functions.dom import Dom
from pagetables.functions.shred import shred_html
from pagetables.spec import Route, SiteSpec


def _url_test(url: Column, rule: Route) -> Column:
    tests = [url.rlike(p) for p in rule.all_of]
    if rule.any_of:
        tests.append(reduce(lambda a, b: a | b, [url.rlike(p) for p in rule.any_of]))
    return reduce(lambda a, b: a & b, tests)


def route(url: Column, spec: SiteSpec, dom: Dom | None = None) -> Column:
    """Label of the first matching rule, NULL when none matches.

    Without ``dom`` the rules that look into the page are passed over; see
    ``needs_page_test`` for the rows where that can change the label.
    """
    label = None
    for rule in spec.routes:
        test = _url_test(url, rule)
        if rule.page is not None:
            if dom is None:
                continue
            test = test & dom.exists(rule.page)
        label = F.when(test, F.lit(rule.label)) if label is None else label.when(
            test, F.lit(rule.label)
        )
    return label


def needs_page_test(url: Column, spec: SiteSpec) -> Column:
    """True when a rule on page content is reached before a URL rule decides."""
    decision = None
    for rule in spec.routes:
        value = F.lit(rule.page is not None)
        test = _url_test(url, rule)
        decision = F.when(test, value) if decision is None else decision.when(test, value)
    return F.coalesce(decision, F.lit(False))


def list_kind(url: Column, spec: SiteSpec) -> Column:
    """Dataset kind of a related-list URL, NULL for lists without a dataset."""
    kinds = iter(spec.list_kinds.items())
    name, pattern = next(kinds)
    found = F.when(url.rlike(pattern), F.lit(name))
    for name, pattern in kinds:
        found = found.when(url.rlike(pattern), F.lit(name))
    return found


@built_once
def _by_url(spec: SiteSpec) -> tuple[Column, Column]:
    url = F.col("effective_url")
    return route(url, spec), list_kind(url, spec)


def route_pages(pages: DataFrame, spec: SiteSpec) -> DataFrame:
    """Add ``route`` and ``list_kind`` from the URL alone and drop foreign pages.

    This runs before any HTML is parsed, and its filters reach the scan. Pages
    staged by ``stage_by_route`` are routed already.
    """
    if "route" in pages.columns:
        return pages
    label, kind = _by_url(spec)
    return (
        pages.withColumn("route", label)
        .filter(F.col("route").isNotNull())
        .withColumn("list_kind", F.when(F.col("route") == "jobRelatedList", kind))
    )


@built_once
def _settled(spec: SiteSpec) -> Column:
    url = F.col("effective_url")
    by_page = route(url, spec, Dom("nodes"))
    label, rules = F.col("route"), list(spec.routes)
    first = next((k for k, rule in enumerate(rules) if rule.page is not None), len(rules))
    # labels that only rules before any on content give are settled; their URLs aren't tested again
    early = {r.label for r in rules[:first]} - {r.label for r in rules[first:]}
    by_url = F.when(needs_page_test(url, spec), by_page).otherwise(label)
    return F.when(label.isin(*sorted(early)), label).otherwise(by_url)


def settle_routes(shredded: DataFrame, spec: SiteSpec) -> DataFrame:
    """Apply the rules on page content to the rows of ``route_pages`` that need it."""
    return shredded.withColumn("route", _settled(spec))


def quarantine(routed: DataFrame, spec: SiteSpec) -> tuple[DataFrame, DataFrame]:
    """Split settled pages into supported ones and ``(url, route, reason)`` rows."""
    bad = F.col("route").isin(*spec.unsupported)
    reason = F.lit(None).cast("string")
    for label, text in spec.unsupported.items():
        reason = F.when(F.col("route") == label, F.lit(text)).otherwise(reason)
    rejected = routed.filter(bad).select(
        F.col("effective_url").alias("url"), "route", reason.alias("reason")
    )
    return routed.filter(~bad), rejected


def redirect_seed(routed: DataFrame, spec: SiteSpec) -> DataFrame:
    """Frontier rows: a home page asks for the offers seed instead."""
    return routed.filter(F.col("route") == "mainPage").select(
        F.lit(spec.seeds["jobOffers"]).alias("url"),
        F.lit("jobListing").alias("label"),
        F.lit(1).alias("listing_page_num"),
        F.col("effective_url").alias("parent_url"),
        F.lit("redirect").alias("reason"),
    )


def shred(pages: DataFrame) -> DataFrame:
    """Replace ``html`` by the columnar DOM, ``nodes``."""
    return pages.withColumn("nodes", shred_html(F.col("html"))).drop("html")


def routed(pages: DataFrame, spec: SiteSpec, *routes: str) -> DataFrame:
    """Pages of some routes by their URLs, not parsed yet."""
    return route_pages(pages, spec).filter(F.col("route").isin(*routes))


def routed_dom(pages: DataFrame, spec: SiteSpec, *routes: str) -> DataFrame:
    """Route by URL, keep the wanted routes, then parse, then settle page rules.

    The order matters: the parser is not deterministic to Catalyst, so only
    filters placed before it spare pages the parsing.
    """
    found = route_pages(pages, spec)
    if routes:
        found = found.filter(F.col("route").isin(*routes))
    return settle_routes(shred(found), spec)
