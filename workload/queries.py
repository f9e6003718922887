"""Registered queries: every operator over whole tables, (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.functions import text as X
from pagetables.functions import urls as U
from pagetables.functions.dom import Dom
from pagetables.operators import detail as D
from pagetables.operators import govern as G
from pagetables.operators import limits as Lim
from pagetables.operators import lists as L
from pagetables.operators import listing as Li
from pagetables.operators import relational as R
from pagetables.operators import routing as Ro
from pagetables.params import OfferFilters, RunParams
from pagetables.plans import datasets as P
from pagetables.schemas import OFFER_DETAILED
from pagetables.sources import arrivals as A
from pagetables.sources.pages import captured
from pagetables.sources.sinks import read_dataset, write_dataset
from pagetables.sources.workspace import cut, workspace
from pagetables.spec import job_board
from pagetables.streaming import ingest as S
from workload import captures as C
from workload.captures import HOST, SITE, table

SPEC = job_board(HOST)
OFFERS = RunParams(dataset="jobOffers")
Query = Callable[[SparkSession, str], DataFrame]


def site_pages(spark: SparkSession, *sources: DataFrame) -> DataFrame:
    pages = sources[0]
    for more in sources[1:]:
        pages = pages.unionByName(more)
    return captured(pages)


def q01_read_pages(spark: SparkSession, sf: str) -> DataFrame:
    loaded = F.when(F.col("url").contains("#"), F.substring_index("url", "#", 1))
    pages = captured(table(spark, sf, "pages").withColumn("loaded_url", loaded))
    return pages.select(
        "page.page_id", "effective_url", F.length("html").cast("bigint").alias("html_chars")
    )


def q02_numbers(spark: SparkSession, sf: str) -> DataFrame:
    price = F.translate(F.format_number(F.round("l_extendedprice", 2), 2), ",.", " ,")
    shown = F.when(F.col("l_returnflag") == "R", "").otherwise(C.text(" ", price, " EUR"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", shown.alias("t"))
    t = F.col("t")
    return lines.select(
        "l_orderkey", "l_linenumber",
        X.str_as_number(t, "int", remove_whitespace=True).alias("whole"),
        X.str_as_number(t, "float", remove_whitespace=True, decimal=",").alias("exact"),
        X.str_as_number(t, "int", remove_whitespace=True, separator=",").alias("cents"),
        X.str_as_number(t, "int").alias("first_group"),
        X.str_or_null(t).isNull().alias("missing"),
    )


def q03_routes(spark: SparkSession, sf: str) -> DataFrame:
    url = F.col("url")
    routed = C.site_urls(spark, sf).select(
        F.coalesce(Ro.route(url, SPEC), F.lit("none")).alias("route"),
        F.when(Ro.route(url, SPEC) == "jobRelatedList", Ro.list_kind(url, SPEC)).alias("list_kind"),
        Ro.needs_page_test(url, SPEC).alias("by_content"),
    )
    return routed.groupBy("route", "list_kind", "by_content").agg(F.count(F.lit(1)).alias("n"))


def q03b_redirects(spark: SparkSession, sf: str) -> DataFrame:
    urls = C.site_urls(spark, sf).select(F.lit(0).alias("page_id"), "url", F.lit("").alias("html"))
    seeds = Ro.redirect_seed(Ro.route_pages(captured(urls), SPEC), SPEC)
    return seeds.select("url", "label", "parent_url", "reason")


def q04_sinks(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
        F.struct("o_orderstatus", F.array("o_custkey").alias("keys")).alias("extra"),
    )
    base, parts = workspace(spark, "sinks"), []
    for fmt in ("parquet", "json", "csv", "xml", "orc"):
        write_dataset(rows, f"{base}/{fmt}", fmt)
        schema = rows.schema
        if fmt == "csv":
            schema = rows.drop("extra").schema.add("extra", "string")
        back = read_dataset(spark, f"{base}/{fmt}", schema, fmt)
        if fmt == "csv":
            back = back.withColumn("extra", F.from_json("extra", rows.schema["extra"].dataType))
        parts.append(back.agg(
            F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"),
            F.sum("cents").alias("cents"), F.sum(F.col("extra.keys")[0]).alias("custkeys"),
            F.countDistinct("o_orderpriority").alias("priorities"),
            F.count_if(F.col("extra.o_orderstatus") == "F").alias("filled"),
        ).select(F.lit(fmt).alias("format"), "*"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).unionByName(parts[4])


def q05_fan_out(spark: SparkSession, sf: str) -> DataFrame:
    pages = site_pages(
        spark, C.listing_pages(spark, sf), C.location_pages(spark, sf), C.company_pages(spark, sf),
        C.partner_pages(spark, sf), C.company_profiles(spark, sf), C.order_detail_pages(spark, sf),
    )
    known = F.col("metadata.originalUrl").isNotNull() & F.col("metadata.contextId").isNotNull()
    return R.dataset_counts(P.fan_out(pages, SPEC, OFFERS), with_metadata=known)


def q05b_archive(spark: SparkSession, sf: str) -> DataFrame:
    """Two crawls in an archive, the second repeated; offers are counted per load, and by the whole archive."""
    root, pages = workspace(spark, "archive"), captured(C.listing_pages(spark, sf))
    details = captured(C.order_detail_pages(spark, sf).unionByName(table(spark, sf, "pages").select("page_id", "url", "html")))
    A.append_load(pages, [SPEC], root, "listings")
    for _ in range(2):
        A.append_load(details, [SPEC], root, "details")
    counts = {
        name: P.fan_out(A.read_loads(spark, SPEC, root, loads), SPEC, OFFERS)["jobOffers"]
        for name, loads in (("listings", ("listings",)), ("details", ("details",)), ("both", None))
    }
    loads = A.loads_of(spark, root).select(F.col("load").alias("kind"), "run", "rows", "left_out")
    offers = R.dataset_counts(counts).withColumnsRenamed({"rows": "offers"})
    return offers.join(loads, "kind", "left")


def q06_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    return P.rejected_pages(captured(C.company_profiles(spark, sf)), SPEC)


def q06b_company_listings(spark: SparkSession, sf: str) -> DataFrame:
    """Company pages with cards: only the content tells a listing from an unsupported design."""
    rows = P.run_dataset(captured(C.company_listings(spark, sf)), SPEC, OFFERS)
    return rows.select("listingUrl", "offerId", "offerUrl", "employerName", "lastChangeType", "salaryRangeLower")


def _shredded(spark: SparkSession, sf: str) -> DataFrame:
    # parsing costs much more than reading, and the table is one file
    parts = max(spark.sparkContext.defaultParallelism, C.tasks(spark, sf, "pages", C.TASK_PAGES))
    return Ro.shred(captured(table(spark, sf, "pages", parts)))


def q07_page_text(spark: SparkSession, sf: str) -> DataFrame:
    dom = Dom("nodes")
    return _shredded(spark, sf).select(
        "page.page_id",
        dom.attr(dom.find("html"), "lang").alias("lang"),
        dom.text(dom.find("head > title")).alias("title"),
        dom.text_lower(dom.find("article h1")).alias("heading"),
        F.md5(dom.text(dom.root())).alias("text_md5"),
        F.size(dom.find_all("p")).cast("bigint").alias("paragraphs"),
    )


def q08_nav_links(spark: SparkSession, sf: str) -> DataFrame:
    dom = Dom("nodes")
    link = F.col("link")
    return (
        _shredded(spark, sf)
        .select(
            "page.page_id", "effective_url",
            F.posexplode(F.transform(dom.find_all("nav ul > li > a[href]"), lambda a: F.struct(
                dom.attr(a, "href").alias("href"), dom.text(a).alias("text"),
                a["nth"].alias("nth"), dom.parent(a)["nth"].alias("item"),
                dom.text(dom.parent(a), without=F.array(a)).alias("rest"),
            ))).alias("pos", "link"),
        )
        .select(
            "page_id", F.col("pos").cast("bigint").alias("pos"), link["item"].cast("bigint").alias("item"),
            U.resolve_url(F.col("effective_url"), link["href"]).alias("href"),
            link["text"].alias("text"), link["rest"].alias("rest"),
        )
    )


def q09_salaries(spark: SparkSession, sf: str) -> DataFrame:
    low, q = F.floor("l_extendedprice"), F.col("l_quantity").cast("bigint")
    n = F.col("l_linenumber")
    shown = (
        F.when(n == 1, C.text(C.spaced(low), " EUR/mesiac"))
        .when(n == 2, C.text("Od ", q, ",5 EUR/hod."))
        .when(n == 3, C.text(C.spaced(low), " - ", C.spaced(low + q), " EUR/mesiac"))
        .when(n == 4, C.text(C.spaced(low), " - ", C.spaced(low + q), " Kč/mesiac"))
        .when(n == 5, C.text(q, ".5 - ", q + 1, ".5 EUR/hod"))
        .when(n == 6, C.text(q, " EUR/deň"))
        .when(F.col("l_returnflag") == "A", "")
        .otherwise(C.text("Od ", low, " - ", low, " EUR/mesiac"))
    )
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", shown.alias("t"))
    return rows.withColumn("pay", X.parse_salary(F.col("t"))).select("l_orderkey", "l_linenumber", "pay.*")


def q10_listing(spark: SparkSession, sf: str) -> DataFrame:
    rows = P.run_dataset(captured(C.listing_pages(spark, sf)), SPEC, OFFERS)
    return rows.withColumn("labels", F.array_join("labels", "|")).drop("metadata")


def q11_detail(spark: SparkSession, sf: str) -> DataFrame:
    pages = Ro.routed_dom(captured(C.part_detail_pages(spark, sf)), SPEC, "jobDetail")
    return D.job_details(pages, SPEC).select(
        "offerUrl", "offerId", "offerName", "employerName", "employerUrl", "employerLogoUrl",
        F.array_join("labels", "|").alias("labels"),
        F.array_join("employmentTypes", "|").alias("employmentTypes"), "startDate", "location",
        F.array_join("phoneNumbers", "|").alias("phoneNumbers"), "datePosted",
        "jobInfoResponsibilities", "jobInfoBenefits", "jobInfoDeadline", "jobReqEducation",
        "jobReqExpertise", "jobReqIndustry", "jobReqOther", "employeeCount", "employerContact",
    )


def q12_categories(spark: SparkSession, sf: str) -> DataFrame:
    pages = Ro.routed_dom(captured(C.customer_detail_pages(spark, sf)), SPEC, "jobDetail")
    rows = D.job_details(pages, SPEC)

    def shown(name: str):
        return F.array_join(F.transform(name, lambda c: F.concat_ws("=", c["name"], c["url"])), "|")

    return rows.select(
        "offerId", F.size("locationCategs").cast("bigint").alias("n_locations"),
        shown("locationCategs").alias("locations"), shown("professionCategs").alias("professions"),
    )


def q13_locations(spark: SparkSession, sf: str) -> DataFrame:
    rows = P.run_dataset(captured(C.location_pages(spark, sf)), SPEC, RunParams(dataset="locations"))
    return rows.select(F.col("metadata.originalUrl").alias("page"), "url", "name", "count", "region", "country")


def q13b_companies(spark: SparkSession, sf: str) -> DataFrame:
    rows = P.run_dataset(captured(C.company_pages(spark, sf)), SPEC, RunParams(dataset="companies"))
    return rows.select("url", "name", "count")


def q14_result_totals(spark: SparkSession, sf: str) -> DataFrame:
    counted = RunParams(dataset="jobOffers", count_only=True)
    return P.run_dataset(captured(C.counter_pages(spark, sf)), SPEC, counted)


def q15_partners(spark: SparkSession, sf: str) -> DataFrame:
    rows = P.run_dataset(captured(C.partner_pages(spark, sf)), SPEC, RunParams(dataset="partners"))
    return rows.drop("metadata")


def q15b_tabs(spark: SparkSession, sf: str) -> DataFrame:
    entry = Ro.routed_dom(captured(C.location_entry_pages(spark, sf)), SPEC, "jobRelatedList")
    tabs = L.tab_fanout(entry, SPEC)
    found = L.list_pages(Ro.routed_dom(captured(C.location_pages(spark, sf)), SPEC, "jobRelatedList"), SPEC)
    return L.captured_tabs(tabs, found).select(
        F.col("effective_url").alias("page"), "tab_name", F.col("tab_index").cast("bigint").alias("tab_index"),
        F.size("entries").cast("bigint").alias("links"),
    )


def q16_urls(spark: SparkSession, sf: str) -> DataFrame:
    url = F.col("url")
    longer = F.concat(
        F.substring_index(url, "#", 1), F.when(url.contains("?"), "&").otherwise("?"),
        F.lit("b=2&a=1%20x&b=1"), F.when(url.contains("#"), "#top").otherwise(""),
    )
    rows = table(spark, sf, "pages").select("page_id", "url", longer.alias("long"))
    long = F.col("long")
    return rows.select(
        "page_id", U.sort_url(long).alias("sorted"), U.url_key(long).alias("key"),
        U.set_query_param(long, "b", F.lit("n")).alias("replaced"),
        U.set_query_param(url, "z", F.col("page_id")).alias("added"),
        U.get_query_param(url, "page").alias("page"),
        U.resolve_url(url, F.lit("../up?x=1")).alias("up"),
        U.resolve_url(long, F.lit("/root"), keep_base_query=True).alias("kept"),
        U.resolve_url_path(long, F.lit("/p")).alias("moved"),
        U.equal_urls(url, long).alias("same"),
    )


def _listing(spark: SparkSession, sf: str, empty_from: int | None = None) -> DataFrame:
    pages = captured(C.listing_pages(spark, sf, empty_from))
    return cut(Li.listing_pages(Ro.routed_dom(pages, SPEC, "jobListing"), SPEC))


def q17_max_entries(spark: SparkSession, sf: str) -> DataFrame:
    kept = Lim.limit_entries(_listing(spark, sf), limit=70, existing=20)
    return Li.explode_entries(kept).select("listing", "page_num", "offerId")


def q17c_run_limit(spark: SparkSession, sf: str) -> DataFrame:
    """One limit for all listings, 30 rows of it delivered before."""
    some = RunParams(dataset="jobOffers", max_entries=2530)
    rows = P.run_dataset(captured(C.listing_pages(spark, sf)), SPEC, some, existing=30)
    return rows.select("offerId", "offerName")


def q17b_until_empty(spark: SparkSession, sf: str) -> DataFrame:
    kept = Lim.limit_entries(_listing(spark, sf, empty_from=40))
    return Li.explode_entries(kept).groupBy("listing").agg(
        F.count(F.lit(1)).alias("n"), F.max("page_num").alias("last_page")
    )


def q18_missing_pages(spark: SparkSession, sf: str) -> DataFrame:
    seen = table(spark, sf, "orders").filter("o_orderstatus <> 'P'").select(
        C.block("o_orderkey", C.PER_PAGE).alias("k")
    ).distinct()
    pages = C.listing_pages(spark, sf)
    whole = F.floor(F.col("page_id") / 1000) * 100 + F.col("page_id") % 1000 - 1
    pages = pages.withColumn("k", whole.cast("bigint")).join(seen, "k", "left_semi").drop("k")
    given = captured(pages)
    listing = cut(Li.listing_pages(Ro.routed_dom(given, SPEC, "jobListing"), SPEC))
    needed = Lim.next_pages(listing).unionByName(Lim.announced_pages(listing))
    gap = R.frontier_gap(needed, given)
    return gap.select("url", "label", F.col("listing_page_num").cast("bigint").alias("listing_page_num"))


def q18c_frontier(spark: SparkSession, sf: str) -> DataFrame:
    """All that a detailed run of offers and a run of locations still need: seeds, next pages, details and tabs."""
    tab = F.col("url").endswith("&tab_index=0")
    offers = site_pages(spark, C.listing_pages(spark, sf), C.order_detail_pages(spark, sf))
    places = site_pages(spark, C.location_entry_pages(spark, sf), C.location_pages(spark, sf).filter(tab))
    needed = [P.missing_pages(offers, SPEC, RunParams(dataset="jobOffers", detailed=True)),
              P.missing_pages(places, SPEC, RunParams(dataset="locations"))]
    return needed[0].unionByName(needed[1]).select("url", "label", "reason")


def q18d_announced_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of announced pages between the first and the last page of each customer's listing."""
    pages = Li.listing_pages(Ro.routed_dom(captured(C.counter_pages(spark, sf)), SPEC, "jobListing"), SPEC)
    return Lim.announced_gaps(cut(pages.select("listing", "page_num", "counter")))


def q18b_filter_urls(spark: SparkSession, sf: str) -> DataFrame:
    asked = OfferFilters(query="asis x", min_salary=6, min_salary_period="hour", employment_type="fte",
                         remote_type="partialRemote", last_n_days=70)
    url = C.text(SITE, "/praca/", F.lower("c_mktsegment"), "/?page_num=", F.col("c_custkey"), "&salary=9")
    rows = table(spark, sf, "customer", C.tasks(spark, sf, "customer", C.TASK_ROWS)).select("c_custkey", url.alias("u"))
    u = F.col("u")
    return rows.select(
        "c_custkey", P.listing_url_with_filters(u, asked).alias("filtered"),
        P.listing_url_with_filters(u, OfferFilters(min_salary=100, employment_type="fte"),
                                   employment_path=True).alias("by_path"),
        Lim.next_page_url(u).alias("next_url"), Li.page_number(u).alias("page_num"),
    )


def _order_offers(spark: SparkSession, sf: str) -> DataFrame:
    low = F.floor(F.col("o_totalprice") / 100)
    values = {
        "offerId": F.col("o_orderkey").cast("string"),
        "offerName": F.col("o_orderpriority"),
        "location": F.col("n_name"),
        "salaryRangeLower": low,
        "salaryRangeUpper": F.when(F.col("o_orderstatus") == "O", low + 500),
        "salaryPeriod": F.when(F.col("o_orderstatus") == "P", "hour").otherwise("month"),
        "employmentTypes": F.array(F.when(F.col("o_orderstatus") == "F", "fte").otherwise("pte")),
        "datePosted": F.date_format("o_orderdate", "yyyy-MM-dd"),
        "listingUrl": C.text(SITE, "/praca/?remote_work=", F.col("n_regionkey")),
        "employerDescription": F.col("c_mktsegment"),
    }
    nation = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    orders = C.joined_orders(spark, sf).join(nation, "n_nationkey")
    return orders.select(*[
        values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in OFFER_DETAILED
    ])


def q19_filters(spark: SparkSession, sf: str) -> DataFrame:
    asked = OfferFilters(query="urgent, HIGH ,auto", min_salary=1500, employment_type="pte",
                         remote_type="fullRemote", last_n_days=1500)
    as_of = F.lit("2000-01-01").cast("date")
    offers = _order_offers(spark, sf).filter(R.offer_filters(asked, F.col, as_of=as_of))
    shaped = G.user_hooks(
        offers, transform=lambda df: df.withColumn("offerName", F.lower("offerName")),
        keep_if="location <> 'NATION_1'",
    )
    return shaped.select("offerId", "offerName", "location", "datePosted", "salaryRangeUpper")


def _merge(spark: SparkSession, sf: str, how: str) -> DataFrame:
    pages = site_pages(spark, C.listing_pages(spark, sf), C.order_detail_pages(spark, sf))
    cards = Li.explode_entries(Li.listing_pages(Ro.routed_dom(pages, SPEC, "jobListing"), SPEC))
    detail = D.job_details(Ro.routed_dom(pages, SPEC, "jobDetail"), SPEC)
    return R.merge_listing_detail(cards, detail, how)


def _merged_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        "offerId", "offerUrl", "listingUrl", "lastChangeType", "lastChangeRelativeTime", "offerName",
        "employerName", F.array_join("labels", "|").alias("labels"), "salaryRangeLower",
        "salaryRangeUpper", F.array_join("employmentTypes", "|").alias("employmentTypes"), "datePosted",
    )


def q20_merge(spark: SparkSession, sf: str) -> DataFrame:
    return _merged_columns(_merge(spark, sf, "listing"))


def q20b_merge_from_detail(spark: SparkSession, sf: str) -> DataFrame:
    return _merged_columns(_merge(spark, sf, "detail"))


def q20c_detail_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Detail pages captured on their own, as start URLs."""
    alone = RunParams(start_urls=(f"{SITE}/praca/acme/O1000000",))
    return _merged_columns(P.run_dataset(captured(C.order_detail_pages(spark, sf)), SPEC, alone))


def q21_only_new(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang", F.md5("text").alias("key"))
    fresh = docs.filter("lang <> 'en'").select("key", "doc_id")
    prior = docs.filter("lang = 'en' or doc_id < 100").select("key")
    return R.only_new(fresh, prior, ("key",), order=("doc_id",))


def q22_redact(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("employerContact"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.array().cast("array<string>"))
        .otherwise(F.array("c_name", "c_mktsegment")).alias("phoneNumbers"),
    )
    private = ("employerContact", "phoneNumbers")
    both = [
        G.redact(rows, private, include).withColumn("opted_in", F.lit(include))
        for include in (False, True)
    ]
    return both[0].unionByName(both[1]).withColumn("phoneNumbers", F.array_join("phoneNumbers", "|"))


def q23_rules(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "pages").select(
        "page_id",
        F.when(F.col("page_id") % 10 == 0, "").when(F.col("page_id") % 10 == 1, None)
        .otherwise(F.col("url")).alias("name"),
        F.when(F.col("url").contains("#"), F.concat(F.lit("https://"), F.col("page_id"), F.lit(".sk/a")))
        .otherwise(F.col("url")).alias("url"),
        (F.col("page_id") - 100).alias("count"),
        F.lit(None).cast("string").alias("region"),
        F.substring_index("url", ":", 1).alias("country"),
    )
    rules = G.rules_for("locations") + [G.one_of("country", "https"), G.http_url("name")]
    return G.violation_counts(rows, rules)


def q23b_violations(spark: SparkSession, sf: str) -> DataFrame:
    rows = _order_offers(spark, sf).withColumn(
        "salaryRangeLower", F.col("salaryRangeLower") - 1000
    ).withColumn("datePosted", F.when(F.col("offerName") == "5-LOW", "5.5.2023").otherwise(F.col("datePosted")))
    rules = G.rules_for("jobOffers", detailed=True)
    return G.violations(rows, rules, ["offerId"])


def q24_stream(spark: SparkSession, sf: str) -> DataFrame:
    base = workspace(spark, "stream")
    pages = table(spark, sf, "pages")
    # every page arrives twice, the second time under a URL with another fragment
    again = pages.withColumn("url", F.concat(F.substring_index("url", "#", 1), F.lit("#again")))
    pages.repartition(4).write.mode("append").parquet(f"{base}/in")
    again.repartition(4).write.mode("append").parquet(f"{base}/in")
    fresh = S.drop_recaptures(S.page_stream(spark, f"{base}/in", files_per_trigger=3))
    S.start_ingest(fresh, S.url_sink(f"{base}/out"), f"{base}/checkpoint").awaitTermination()
    out = spark.read.schema("url_key string, page_id bigint, batch_id int").parquet(f"{base}/out")
    # which of several captures of a URL comes first is up to the stream
    return out.select("url_key")


def q24b_late_captures(spark: SparkSession, sf: str) -> DataFrame:
    """Files in reverse order of capture, each page twice: every capture is kept, late or a repeat."""
    base = workspace(spark, "reverse")
    pages = table(spark, sf, "pages")
    day = (F.col("page_id") % 10).cast("int")
    dated = pages.withColumn("fetched_at", F.date_add(F.lit("2024-05-01").cast("date"), day).cast("timestamp"))
    again = dated.withColumn("url", F.concat(F.substring_index("url", "#", 1), F.lit("#again")))
    sink = S.dedupe_sink(base, "3 days")
    for n, part in enumerate((dated.filter(day >= 8), dated.filter(day < 8), again)):
        sink(captured(part), n)
    return S.captures_of(spark, base)


def q25_salary_by_location(spark: SparkSession, sf: str) -> DataFrame:
    offers = P.run_dataset(captured(C.listing_pages(spark, sf)), SPEC, OFFERS)
    return offers.filter(F.col("salaryRangeLower").isNotNull()).groupBy("location", "salaryCurrency").agg(
        F.count(F.lit(1)).alias("offers"), F.sum("salaryRangeLower").alias("sum_lower"),
        F.max("salaryRangeUpper").alias("max_upper"),
    )


def q26_ingest(spark: SparkSession, sf: str) -> DataFrame:
    base = workspace(spark, "ingest")
    pages = C.location_pages(spark, sf).unionByName(C.company_profiles(spark, sf)).unionByName(
        C.partner_pages(spark, sf)
    )
    pages.coalesce(C.FILES).write.mode("append").parquet(f"{base}/in")
    kinds = ("locations", "partners")
    S.ingest(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", SPEC,
             RunParams(dataset="locations"), kinds)
    counts = R.dataset_counts({
        k: spark.read.schema("url string, batch_id int").parquet(f"{base}/out/{k}")
        for k in (*kinds, "rejected")
    })
    return counts


def q26b_late_captures(spark: SparkSession, sf: str) -> DataFrame:
    """Listings filed with the latest first, and half of them captured again in a second run."""
    base = workspace(spark, "late")
    pages = C.listing_pages(spark, sf)
    day = F.pmod(F.xxhash64("page_id"), F.lit(20)).cast("int")
    dated = pages.withColumn("fetched_at", F.date_sub(F.lit("2024-05-31").cast("date"), day).cast("timestamp"))
    again = dated.filter(F.col("page_id") % 2 == 0).withColumn("fetched_at", F.lit("2024-04-01").cast("timestamp"))
    for part in (dated.filter(day < 10), dated.filter(day >= 10), again):
        part.coalesce(C.FILES).write.mode("append").parquet(f"{base}/in")
        S.ingest(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", SPEC, OFFERS, ("jobOffers",))
    return spark.read.schema("offerId string, offerName string, batch_id int").parquet(f"{base}/out/jobOffers").select("offerId", "offerName")


def q26c_detailed_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Detail pages that come before, with and after their listings, and some without any."""
    base = workspace(spark, "detailed")
    details = C.order_detail_pages(spark, sf)
    early = F.pmod(F.xxhash64("page_id"), F.lit(2)) == 0
    params = RunParams(dataset="jobOffers", detailed=True)
    for part in (details.filter(early), C.listing_pages(spark, sf), details.filter(~early)):
        part.coalesce(C.FILES).write.mode("append").parquet(f"{base}/in")
        S.ingest(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", SPEC, params, ("jobOffers",))
    return _merged_columns(S.delivered_rows(spark, f"{base}/out", "jobOffers"))


def queries() -> dict[str, Query]:
    found = {name: fn for name, fn in globals().items() if name[0] == "q" and name[1:3].isdigit()}
    return dict(sorted(found.items()))
