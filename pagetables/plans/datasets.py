"""From captured pages to a typed dataset."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetables.functions.urls import set_query_params, url_key
from pagetables.operators import detail as D
from pagetables.operators import lists as L
from pagetables.operators import listing as Li
from pagetables.operators.govern import redact, user_hooks, with_metadata
from pagetables.operators.limits import frontier, limit_entries, limit_rows, next_pages, run_rows
from pagetables.operators.relational import (
    detail_key, entry_key, filter_cards, frontier_gap, latest_captures, merge_listing_detail, offer_filters, only_new,
)
from pagetables.operators.routing import (
    list_kind, needs_page_test, quarantine, redirect_seed, route, route_pages, routed, routed_dom,
)
from pagetables.params import OfferFilters, RunParams
from pagetables.schemas import dataset_schema
from pagetables.sources.workspace import cut, workspace
from pagetables.spec import (
    DATASET_KINDS, EMPLOYMENT_PATHS, PERIOD_CODES, PRIVATE_FIELDS, REMOTE_CODES, SiteSpec,
)


UNKNOWN_LIST = "related list without a dataset"


def listing_url_with_filters(url: Column, filters: OfferFilters,
                             employment_path: bool = False) -> Column:
    """Listing URL that asks the site for the filtered offers.

    The employment type leaves the URL as it is, as on the original pages;
    ``employment_path`` puts its path segment in.
    """
    values: dict[str, Column] = {}
    if filters.query is not None:
        values["search_anywhere"] = F.lit(filters.query)
    if filters.last_n_days is not None:
        values["count_days"] = F.lit(filters.last_n_days)
    if filters.remote_type is not None:
        values["remote_work"] = F.lit(REMOTE_CODES[filters.remote_type])
    if filters.min_salary is not None:
        values["salary"] = F.lit(filters.min_salary)
        values["salary_period"] = F.lit(PERIOD_CODES[filters.salary_period])
    if employment_path and filters.employment_type is not None:
        segment = EMPLOYMENT_PATHS[filters.employment_type]
        moved = F.regexp_replace(url, r"(?i)^([^?#]*?//[^/?#]*/praca/)", f"$1{segment}/")
        url = F.when(url.contains(segment), url).otherwise(moved)
    return set_query_params(url, values) if values else url


#: Where a row stands in its run; limits count in this order.
ORDER = ("listing", "page_num", "pos")


def listing_of(pages: DataFrame, spec: SiteSpec, params: RunParams) -> DataFrame:
    """Listing pages, one row per listing and page number, the latest capture."""
    shown = latest_captures(routed(pages, spec, "jobListing"), Li.page_key())
    return Li.listing_pages(routed_dom(shown, spec, "jobListing"), spec, params.keep_base_query)


def offer_cards(pages: DataFrame, spec: SiteSpec, params: RunParams) -> DataFrame:
    """Cards that pass what a card can answer; with a limit, up to a listing's first empty page."""
    listing = filter_cards(listing_of(pages, spec, params), params.filters, params.detailed)
    if params.max_entries is not None:
        listing = limit_entries(cut(listing, "listing"))
    return Li.explode_entries(listing)


def offer_details(pages: DataFrame, spec: SiteSpec, params: RunParams) -> DataFrame:
    """Detail pages, one row per page, the latest capture."""
    shown = latest_captures(routed(pages, spec, "jobDetail"), detail_key(F.col("page.url")))
    return D.job_details(routed_dom(shown, spec, "jobDetail"), spec, params.keep_base_query)


def detail_keys(pages: DataFrame, spec: SiteSpec) -> DataFrame:
    """Keys of the captured detail pages, from their URLs alone."""
    return routed(pages, spec, "jobDetail").select(detail_key(F.col("page.url")).alias("_offer"))


def detailed_offers(cards: DataFrame, detail: DataFrame, params: RunParams, how: str = "both",
                    keys: DataFrame | None = None, unique: bool = False) -> DataFrame:
    """Cards with their detail pages, and detail pages without a card, that pass the filters.

    The filters see the merged row, as the detail page overwrites what a card says.
    """
    merged = merge_listing_detail(cards, detail, how, ORDER, keys, unique)
    return _in_run(merged.filter(offer_filters(params.filters, F.col)))


def _in_run(merged: DataFrame) -> DataFrame:
    """Offers without a card come after the listings, in parts of the run's order."""
    place = F.xxhash64("offerUrl")
    return merged.withColumns({
        "page_num": F.when(F.col("listing").isNull(), F.pmod(place, F.lit(1 << 16))).otherwise(F.col("page_num")),
        "pos": F.when(F.col("listing").isNull(), place).otherwise(F.col("pos").cast("bigint")),
        "listing": F.coalesce("listing", F.lit("\U0010ffff")),
    })


def lone_offers(detail: DataFrame, params: RunParams) -> DataFrame:
    """Detail pages that no card leads to, as offers of their own, as far as they pass the filters."""
    alone = detail.select(
        "page", *[f.name for f in dataset_schema("jobOffers", True) if f.name != "metadata"],
        F.lit(None).cast("string").alias("listing"), F.lit(None).cast("bigint").alias("page_num"), F.lit(None).cast("int").alias("pos"),
    )
    return _in_run(alone.filter(offer_filters(params.filters, F.col)))


def without_card(rows: DataFrame, url: Column, cards: DataFrame) -> DataFrame:
    """Rows whose detail page none of the cards leads to."""
    led = cards.filter(F.col("offerUrl").isNotNull()).select(detail_key(F.col("offerUrl")).alias("_offer")).distinct()
    return rows.withColumn("_offer", detail_key(url)).join(led, "_offer", "left_anti").drop("_offer")


def offers(pages: DataFrame, spec: SiteSpec, params: RunParams, lone_details: bool = False) -> DataFrame:
    """Job offers: cards of the listing pages, with their detail pages if asked for.

    A detailed run also has the captured detail pages that no card leads to; with ``lone_details`` a simple run has
    them too, as far as a card's fields go, and parses no others.
    """
    if params.count_only:
        return Li.result_totals(listing_of(pages, spec, params))
    cards = offer_cards(pages, spec, params)
    if params.detailed:
        return detailed_offers(cards, offer_details(pages, spec, params), params, "both", detail_keys(pages, spec), unique=True)
    if not lone_details:
        return cards
    cards = cut(cards, "cards")
    details = without_card(routed(pages, spec, "jobDetail"), F.col("page.url"), cards)
    alone = replace(params, detailed=True)
    names = ["page", *[f.name for f in dataset_schema("jobOffers", False) if f.name != "metadata"], *ORDER]
    own = lone_offers(offer_details(details, spec, alone), alone).select(*names)
    return cards.select(*names[:-1], F.col("pos").cast("bigint").alias("pos")).unionByName(own)


def start_datasets(spark: SparkSession, spec: SiteSpec, urls: tuple[str, ...]) -> dict[str, set[str]]:
    """The datasets that start URLs belong to, each with the routes that lead to it."""
    u = F.col("u")
    found: dict[str, set[str]] = {}
    for r in spark.createDataFrame([(x,) for x in urls], "u string").select(route(u, spec).alias("r"), list_kind(u, spec).alias("k")).collect():
        kind = {"jobListing": "jobOffers", "jobDetail": "jobOffers", "mainPage": "jobOffers", "partners": "partners"}.get(r.r)
        kind = r.k if r.r == "jobRelatedList" else kind
        if kind is None:
            raise ValueError(f"no dataset for a start URL of route {r.r}")
        found.setdefault(kind, set()).add(r.r)
    return found


def link_list(pages: DataFrame, kind: str, spec: SiteSpec, params: RunParams) -> DataFrame:
    """Companies, industries, professions, languages or locations, from all captured tabs.

    A list page without a tab in its URL shows the first one; captures of the
    same tab count once, the latest.
    """
    wanted = latest_captures(routed(pages, spec, "jobRelatedList").filter(F.col("list_kind") == kind), L.list_key())
    found = L.list_pages(
        routed_dom(wanted, spec, "jobRelatedList"), spec, params.keep_base_query
    )
    links = in_order(L.explode_rows(found))
    return L.locations_list(links) if kind == "locations" else L.generic_list(links, kind)


def partner_list(pages: DataFrame, spec: SiteSpec, params: RunParams) -> DataFrame:
    shown = latest_captures(routed(pages, spec, "partners"), url_key(F.col("effective_url")))
    found = L.partner_pages(routed_dom(shown, spec, "partners"), spec, params.keep_base_query)
    return in_order(L.explode_rows(found))


def in_order(rows: DataFrame) -> DataFrame:
    """Rows of a list page, which is a listing of one page."""
    return rows.withColumns({"listing": F.col("capture"), "page_num": F.lit(1).cast("bigint")})


def run_dataset(pages: DataFrame, spec: SiteSpec, params: RunParams,
                prior: DataFrame | None = None, existing: int = 0, lone_details: bool = False,
                keep_new: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One dataset with everything the run options ask for.

    ``pages`` is the output of ``read_pages``; ``prior`` is earlier output of the
    same dataset, whose entries are left out; ``existing`` counts rows already
    delivered towards ``max_entries``, which is one limit for the whole run.
    Start URLs choose the dataset by their route; a run from detail pages alone gives detailed rows.
    ``lone_details`` gives simple runs the detail pages too that no card leads to; detailed runs have them.
    With a limit or a merge with lone detail pages, jobs that stage rows run right away.
    """
    kind, lone = params.dataset or "jobOffers", lone_details
    if params.start_urls:
        started = start_datasets(pages.sparkSession, spec, params.start_urls)
        if len(started) > 1:
            raise ValueError(f"start URLs of several datasets: {sorted(started)}; run each on its own")
        kind, routes = next(iter(started.items()))
        lone = lone or "jobDetail" in routes
        if routes == {"jobDetail"}:
            params = replace(params, detailed=True)
    if kind == "jobOffers":
        rows = offers(pages, spec, params, lone)
        if params.count_only:
            return rows
    elif kind == "partners":
        rows = partner_list(pages, spec, params)
    else:
        rows = link_list(pages, kind, spec, params)
    return finished(rows, kind, params, prior, existing, keep_new)


def finished(rows: DataFrame, kind: str, params: RunParams, prior: DataFrame | None = None,
             existing: int = 0, keep_new: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Extracted rows as the dataset shows them: only new ones, up to the limit, masked and through the user's hooks.

    ``keep_new`` takes the place of ``prior`` where old entries are known in another way.
    """
    fields = dataset_schema(kind, params.detailed).fieldNames()
    rows = with_metadata(rows, params).select(*fields, "metadata", *[F.col(c).alias(f"_{c}") for c in ORDER])
    if prior is not None:
        rows = only_new(rows, prior, entry_key(kind))
    if keep_new is not None:
        rows = keep_new(rows)
    if params.max_entries is not None:
        ordered = rows.withColumnsRenamed({f"_{c}": c for c in ORDER})
        rows = limit_rows(cut(ordered, "rows"), params.max_entries, existing).select(*fields, "metadata")
    rows = rows.select(*fields, "metadata")
    if kind == "jobOffers" and params.detailed:
        rows = redact(rows, PRIVATE_FIELDS, params.include_personal_data)
    return user_hooks(rows, params.transform, params.keep_if)


def rejected_pages(pages: DataFrame, spec: SiteSpec) -> DataFrame:
    """The quarantine table: unsupported pages with the reason, and lists without a dataset.

    Only pages whose route hangs on their content are parsed.
    """
    routed = route_pages(pages, spec)
    doubtful = routed.filter(needs_page_test(F.col("effective_url"), spec))
    nameless = routed.filter((F.col("route") == "jobRelatedList") & F.col("list_kind").isNull()).select(
        F.col("effective_url").alias("url"), "route", F.lit(UNKNOWN_LIST).alias("reason")
    )
    return quarantine(routed_dom(doubtful, spec), spec)[1].unionByName(nameless)


def stage_by_route(pages: DataFrame, spec: SiteSpec, path: str | None = None) -> DataFrame:
    """Write the site's pages once, partitioned by route and list kind, and read
    them back. Every dataset then reads its own partition and not all pages."""
    path = path or workspace(pages.sparkSession, "routed")
    route_pages(pages, spec).write.mode("overwrite").partitionBy("route", "list_kind").parquet(path)
    routed = [T.StructField("route", T.StringType()), T.StructField("list_kind", T.StringType())]
    schema = T.StructType([*pages.schema.fields, *routed])
    return pages.sparkSession.read.schema(schema).parquet(path)


def fan_out(pages: DataFrame, spec: SiteSpec, params: RunParams,
            stage: bool = True) -> dict[str, DataFrame]:
    """All datasets of one crawl, by kind, from one pass over the captured pages.

    Every page of a route feeds its dataset: detail pages that no card leads to are offers, also of a simple run. Pages of
    an archive (``read_loads``) are laid out by route already; others are staged so, unless ``stage`` is off.
    """
    if stage and "route" not in pages.columns:
        pages = stage_by_route(pages, spec)
    return {
        kind: run_dataset(pages, spec, replace(params, dataset=kind, start_urls=None), lone_details=True)
        for kind in DATASET_KINDS
    }


def missing_pages(pages: DataFrame, spec: SiteSpec, params: RunParams, existing: int = 0) -> DataFrame:
    """Frontier of pages still to be captured for a run, in the frontier schema.

    Seeds, next listing pages, detail pages (detailed runs) and list tabs, less
    what is captured. The limit counts the rows that ``run_dataset`` would give, so pages and details
    past it aren't asked for.
    """
    spark = pages.sparkSession
    kinds = start_datasets(spark, spec, params.start_urls) if params.start_urls else {params.dataset: set()}
    urls = params.start_urls or (spec.seeds[params.dataset],)
    seeds = spark.createDataFrame([(u,) for u in urls], "u string")
    listed = F.when(route(F.col("u"), spec) == "jobListing", listing_url_with_filters(F.col("u"), params.filters))
    needed = frontier(
        seeds, url=F.coalesce(listed, F.col("u")) if params.start_urls else listing_url_with_filters(F.col("u"), params.filters),
        label=None, page_num=F.lit(1), parent=F.lit(None), reason="seed",
    ).unionByName(redirect_seed(route_pages(pages, spec), spec))
    if "jobOffers" in kinds and kinds["jobOffers"] != {"jobDetail"}:
        needed = needed.unionByName(_offer_frontier(pages, spec, params, existing))
    if set(kinds) - {"jobOffers", "partners"}:
        tabs = L.tab_fanout(routed_dom(pages, spec, "jobRelatedList"), spec)
        needed = needed.unionByName(frontier(
            tabs, url=F.col("tab_url"), label="jobRelatedList", page_num=F.lit(None),
            parent=F.col("base_url"), reason="list tab",
        ))
    return frontier_gap(needed, pages)


def _offer_frontier(pages: DataFrame, spec: SiteSpec, params: RunParams, existing: int) -> DataFrame:
    """Next listing pages, and the detail pages of a detailed run's cards, up to the run's limit."""
    limit, at = params.max_entries, ["listing", "page_num"]
    listing = cut(filter_cards(listing_of(pages, spec, params), params.filters, params.detailed), "listing")
    if not params.detailed:
        return next_pages(listing, limit, existing, per_run=True)
    cards = Li.explode_entries(listing)
    if limit is not None:
        rows = detailed_offers(cards, offer_details(pages, spec, params), params, "listing")
        counts = rows.groupBy(*at).agg(F.count(F.lit(1)).alias("_n"))
        listing = cut(listing.join(counts, at, "left").withColumn("n", F.coalesce("_n", F.lit(0))).drop("_n"), "listing")
        wanted = run_rows(listing).filter(F.col("before") < max(limit - existing, 0)).select(*at)
        cards = cards.join(wanted, at, "left_semi")
    return next_pages(listing, limit, existing, per_run=True).unionByName(frontier(
        cards.filter(F.col("offerUrl").isNotNull()), url=F.col("offerUrl"), label="jobDetail", page_num=F.lit(None),
        parent=F.col("listingUrl"), reason="offer detail",
    ))
