"""Link lists (companies, industries, professions, languages, locations) and partners."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.functions.arrays import built_once, fill_headings, let, rank
from pagetables.functions.dom import Dom
from pagetables.functions.text import str_as_number
from pagetables.functions.urls import get_query_param, resolve_against, set_query_param, split_url, url_key
from pagetables.operators.listing import explode_once
from pagetables.operators.relational import capture_order, latest
from pagetables.spec import HOME_COUNTRY, SiteSpec


def nav_tabs(dom: Dom, selector: str) -> Column:
    """Non-empty tab names of a page; a page without tabs has one unnamed tab."""
    names = dom.texts(dom.find_all(selector))
    return F.when(F.size(names) > 0, names).otherwise(
        F.array(F.lit(None).cast("string"))
    )


def tab_index(url: Column) -> Column:
    """Number of the tab a captured page shows; 0 when the URL does not say."""
    return F.coalesce(str_as_number(get_query_param(url, "tab_index"), "int"), F.lit(0)).cast("int")


def tab_fanout(shredded: DataFrame, spec: SiteSpec) -> DataFrame:
    """Related-list page -> one row per tab, with the URL of the tab's own page."""
    url = F.col("effective_url")
    return shredded.filter(F.col("route") == "jobRelatedList").select(
        F.col("page.page_id").alias("page_id"), url.alias("base_url"), "list_kind",
        F.posexplode(nav_tabs(Dom("nodes"), spec.links["tab"])).alias("tab_index", "tab_name"),
    ).withColumn(
        "tab_url", set_query_param(F.col("base_url"), "tab_index", F.col("tab_index"))
    )


def captured_tabs(fanout: DataFrame, pages: DataFrame) -> DataFrame:
    """Tabs with their captured ``list_pages``, joined on the canonical URL.

    Both sides are reduced to one row per URL first, so a page captured many
    times neither multiplies its links nor ends up in one task.
    """
    pages = latest(pages, "capture", *capture_order())
    tabs = fanout.groupBy(url_key(F.col("tab_url")).alias("capture")).agg(
        F.max("tab_name").alias("tab_name")
    )
    return pages.join(tabs, "capture")


def _count(dom: Dom, node: Column) -> Column:
    return F.coalesce(
        str_as_number(dom.text(node), "int", remove_whitespace=True), F.lit(0).cast("bigint")
    )


def related_links(dom: Dom, base: Column, spec: SiteSpec,
                  keep_base_query: bool = False) -> Column:
    """Links of one list page with the heading each stands under, in page order.

    A link holding a heading starts a new group and is a row itself. Its counter
    is taken out of its name, and out of the page for the links after it.
    """
    css = spec.links
    return dom.scoped([css["heading"], css["count"]], lambda d: _links_of(d, base, spec, keep_base_query))


def _links_of(dom: Dom, base: Column, spec: SiteSpec, keep_base_query: bool) -> Column:
    css = spec.links

    def real_link(n: Column) -> Column:
        href = dom.attr(n, "href")
        return href.isNotNull() & (href != "") & ~href.startswith("#")

    def marked(n: Column) -> Column:
        heading = dom.find(css["heading"], n)
        return F.struct(
            n.alias("node"),
            heading.isNotNull().alias("is_heading"),
            F.when(heading.isNotNull(), dom.find(css["count"], n)).alias("taken"),
        )

    def name_of(m: Column) -> Column:
        return dom.text(m["node"], without=F.array(m["taken"]))

    def rows(links: Column) -> Column:
        """A plain link's count is the first counter under its parent that no heading above it has taken.

        Counters are found once per page, those that headings take apart from the others, and looked up by position.
        """
        taken = F.filter(F.transform(links, lambda m: m["taken"]), lambda t: t.isNotNull())

        def first(counters: Column, after: Column, parent: Column) -> Column:
            """The first counter behind a position, if it is under the parent."""
            return let(
                F.get(counters, rank(counters, after)), lambda c: F.when(c["id"] <= parent["last"], c)
            )

        def count_node(m: Column, c: Column) -> Column:
            def beside(p: Column) -> Column:
                free = first(c["free"], p["id"], p)
                # a heading's own counter is still there for the links above the heading
                later = first(c["taken"], F.greatest(p["id"], m["node"]["id"] - 1), p)
                return let(F.struct(free.alias("a"), later.alias("b")), lambda x: F.when(
                    x["a"].isNull() | (x["b"]["id"] < x["a"]["id"]), x["b"]
                ).otherwise(x["a"]))

            return F.when(m["is_heading"], m["taken"]).otherwise(let(dom.parent(m["node"]), beside))

        def counters(gone: Column) -> Column:
            free = F.filter(dom.find_all(css["count"]), lambda s: let(
                rank(gone, s["id"]), lambda k: (k == 0) | (F.get(gone, k - 1)["id"] < s["id"])
            ))
            return F.struct(free.alias("free"), gone.alias("taken"))

        return let(let(taken, counters), lambda gone: fill_headings(
            links,
            is_heading=lambda m: m["is_heading"],
            heading=name_of,
            build=lambda m, title: F.struct(
                resolve_against(base, dom.attr(m["node"], "href"), keep_base_query).alias("url"),
                name_of(m).alias("name"),
                _count(dom, count_node(m, gone)).alias("count"),
                title.alias("heading"),
            ),
        ))

    scope = dom.parent(dom.find(css["title"]))
    links = F.transform(F.filter(dom.find_all(css["link"], scope), real_link), marked)
    return let(links, rows)


@built_once
def _links(spec: SiteSpec, keep_base_query: bool) -> Column:
    return related_links(Dom("nodes"), F.col("_base"), spec, keep_base_query)


@built_once
def _partners(spec: SiteSpec, keep_base_query: bool) -> Column:
    return partner_entries(Dom("nodes"), F.col("_base"), spec, keep_base_query)


def list_key() -> Column:
    """Names a captured list page and its tab; a URL without a tab is the first tab."""
    url = F.col("effective_url")
    return url_key(F.coalesce(set_query_param(url, "tab_index", tab_index(url)), url))


def list_pages(shredded: DataFrame, spec: SiteSpec, keep_base_query: bool = False) -> DataFrame:
    """One compact row per captured list page: its tab, its links and its key, ``capture``. No shuffle."""
    url = F.col("effective_url")
    return (
        shredded.filter(F.col("route") == "jobRelatedList")
        .withColumn("_base", split_url(url))
        .withColumn("entries", _links(spec, keep_base_query))
        .withColumn("tab_index", tab_index(url))
        .withColumn("capture", list_key())
        .drop("nodes", "_base")
    )


def explode_rows(pages: DataFrame) -> DataFrame:
    """Page rows -> one row per entry, with its position as ``pos``."""
    keep = [c for c in pages.columns if c != "entries"]
    return explode_once(pages, keep).select("*", "entry.*").drop("entry")


def generic_list(links: DataFrame, kind: str) -> DataFrame:
    """Companies, industries, professions or languages."""
    return links.filter(F.col("list_kind") == kind)


def locations_list(links: DataFrame) -> DataFrame:
    """Locations: the first tab lists the home country by region, the others by country."""
    home = F.col("tab_index") == 0
    return (
        links.filter(F.col("list_kind") == "locations")
        .withColumn("region", F.when(home, F.col("heading")))
        .withColumn("country", F.when(home, F.lit(HOME_COUNTRY)).otherwise(F.col("heading")))
    )


def partner_entries(dom: Dom, base: Column, spec: SiteSpec,
                    keep_base_query: bool = False) -> Column:
    """Partner rows of one page; the i-th card belongs to the i-th tab name."""
    css = spec.partners
    of_a_row = [css[k] for k in ("row", "info", "link", "logo")]
    return dom.scoped(of_a_row, lambda d: _partners_of(d, base, spec, keep_base_query))


def _partners_of(dom: Dom, base: Column, spec: SiteSpec, keep_base_query: bool) -> Column:
    css = spec.partners

    def entry(row: Column, category: Column) -> Column:
        return let(dom.find(css["info"], row), lambda info: let(
            dom.find(css["link"], info),
            lambda a: F.struct(
                dom.text(a).alias("name"),
                resolve_against(base, dom.attr(a, "href"), keep_base_query).alias("url"),
                dom.text(info, without=F.array(a)).alias("description"),
                resolve_against(
                    base, dom.attr(dom.find(css["logo"], row), "src"), keep_base_query
                ).alias("logoUrl"),
                category.alias("category"),
            ),
        ))

    tabs = dom.texts(dom.find_all(css["tab"]))
    return let(tabs, lambda names: F.flatten(F.transform(
        dom.find_all(css["card"]),
        lambda card, i: let(
            F.get(names, i),
            lambda category: F.transform(
                dom.find_all(css["row"], card), lambda row: entry(row, category)
            ),
        ),
    )))


def partner_pages(shredded: DataFrame, spec: SiteSpec, keep_base_query: bool = False) -> DataFrame:
    """One compact row per captured partner page. No shuffle."""
    url = F.col("effective_url")
    return (
        shredded.filter(F.col("route") == "partners")
        .withColumn("_base", split_url(url))
        .withColumn("entries", _partners(spec, keep_base_query))
        .withColumn("capture", url_key(url))
        .drop("nodes", "_base")
    )
