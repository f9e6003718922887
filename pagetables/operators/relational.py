"""Joins, dedupe, counts and filters over extracted rows."""

from __future__ import annotations

import warnings
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.functions.text import offer_id
from pagetables.functions.urls import get_query_param, url_key
from pagetables.params import OfferFilters
from pagetables.schemas import DESCRIPTION_FIELDS, OFFER_DETAILED
from pagetables.sources.workspace import cut
from pagetables.spec import REMOTE_CODES

#: What a detailed row takes from its listing card; everything else is the detail page's.
FROM_LISTING = ("listingUrl", "lastChangeRelativeTime", "lastChangeType")
#: Texts the keyword filter looks at.
SEARCHED = ("offerName", "employerName", "location")
SEARCHED_DETAILED = DESCRIPTION_FIELDS
#: Default identity of a row for "only new entries", per dataset kind.
ENTRY_KEYS = {"jobOffers": ("offerId",)}


#: Keys of some tens of bytes that may be broadcast.
_FEW = 200_000


def entry_key(kind: str) -> tuple[str, ...]:
    return ENTRY_KEYS.get(kind, ("url",))


def latest(rows: DataFrame, key: str, *order: Column) -> DataFrame:
    """One row per key, the greatest by ``order``.

    A max-by aggregate rather than a window: copies of a key collapse to one row
    per input partition before the shuffle, so a key with a third of all rows
    costs no more than any other. Rows without key stay apart by nature and are
    dropped, as nothing can refer to them.
    """
    everything = F.struct(*rows.columns)
    return (
        rows.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.max_by(everything, F.struct(*order)).alias("_row"))
        .select(*[F.col("_row")[c].alias(c) for c in rows.columns])
    )


def capture_order() -> tuple[Column, Column]:
    """Later captures win; the page id settles ties."""
    return F.col("page.fetched_at"), F.col("page.page_id")


def latest_captures(pages: DataFrame, key: Column) -> DataFrame:
    """Captured pages without those that a later capture of the same page replaces, before anything is parsed.

    Which captures stay is decided on keys, times and ids alone, in a job that runs right away and finds the keys captured more
    than once. Only these are looked up again, and they are broadcast if a count shows that they are few; so the pages
    themselves stay where they are. Of captures that agree in time and id one stays, by its content. Pages without a key are
    dropped, as nothing can refer to them.
    """
    order = F.struct(*[c.alias(f"o{k}") for k, c in enumerate(capture_order())])
    keyed = pages.withColumns({"_key": key, "_order": order}).filter(F.col("_key").isNotNull())
    times = keyed.groupBy("_key", "_order").agg(F.count(F.lit(1)).alias("_n"))
    tops = times.groupBy("_key").agg(F.max(F.struct("_order", "_n")).alias("_top"), F.sum("_n").alias("_all")).filter("_all > 1").select(
        "_key", F.col("_top._order").alias("_top"), (F.col("_top._n") > 1).alias("_tied")
    )
    columns = pages.columns
    again = tops.limit(_FEW + 1).count()
    if not again:
        return keyed.select(*columns)
    tops = cut(tops, "recaptured")
    if again <= _FEW:
        tops = F.broadcast(tops)
    marked = keyed.join(tops, "_key", "left")
    single = marked.filter(F.col("_top").isNull() | (F.col("_order").eqNullSafe(F.col("_top")) & ~F.col("_tied"))).select(*columns)
    if tops.filter("_tied").isEmpty():
        return single
    same = keyed.join(tops.filter("_tied"), "_key").filter(F.col("_order").eqNullSafe(F.col("_top")))
    one = same.groupBy("_key").agg(F.max_by(F.struct(*columns), F.xxhash64("html")).alias("_row")).select(
        *[F.col("_row")[c].alias(c) for c in columns]
    )
    return single.unionByName(one)


def latest_pages(pages: DataFrame) -> DataFrame:
    """One row per listing and page number, the latest capture."""
    keyed = pages.withColumn("_at", F.struct("listing", "page_num"))
    return latest(keyed, "_at", *capture_order()).drop("_at")


def detail_key(url: Column) -> Column:
    """What a card's offer URL and its detail page's URL share."""
    return url_key(url)


def merge_listing_detail(listing: DataFrame, detail: DataFrame, how: str = "listing",
                         carry: tuple[str, ...] = (), keys: DataFrame | None = None,
                         unique: bool = False) -> DataFrame:
    """Overlay listing rows with their detail pages.

    The detail page wins even where it has nothing; only ``FROM_LISTING`` comes
    from the card. ``how="listing"``: one row per card with a captured detail
    page, cards without an offer URL skipped. ``how="both"``: these, and the
    detail pages that no card leads to. ``how="detail"``: one row per
    detail page and card, or per page alone when no card leads to it.
    Columns of the cards named in ``carry`` come along.

    Detail pages captured more than once count once, so cards cannot multiply; ``unique`` says that they are
    no more than one per key already. The cards are cut down to a key and a few columns before they shuffle.
    For detail pages without a card, a stand-in without fields joins the cards; these are found on keys alone (``keys``, a
    column ``_offer``; without it the parsed pages are staged). So there is one inner join, whose card side
    adaptive execution can split over many tasks if one offer is on very many cards.
    """
    if how not in ("listing", "detail", "both"):
        raise ValueError(f"how must be 'listing', 'detail' or 'both', got {how!r}")
    by_listing = how != "detail"
    pages = detail.withColumn("_offer", detail_key(F.col("page.url"))).filter(F.col("_offer").isNotNull())
    if not unique:
        pages = latest(pages, "_offer", *capture_order())
    carried = [F.col("page").alias("_page"), F.col("offerUrl").alias("_url")]
    cards = (
        listing.filter(F.col("offerUrl").isNotNull())
        .withColumn("_offer", detail_key(F.col("offerUrl")))
        .select(
            "_offer",
            *[F.col(c).alias("_" + c) for c in FROM_LISTING],
            *(carried if by_listing else []),
            *[F.col(c).alias("_" + c) for c in carry],
        )
    )
    if how != "listing":
        cards = cut(cards, "cards")
        if keys is None:
            pages = cut(pages, "details")
            keys = pages.select("_offer")
        alone = keys.filter(F.col("_offer").isNotNull()).distinct().join(cards.select("_offer").distinct(), "_offer", "left_anti")
        cards = cards.unionByName(alone, allowMissingColumns=True)
    merged = pages.drop(*FROM_LISTING).join(cards, "_offer")
    values = {c: F.col("_" + c) for c in FROM_LISTING}
    page = F.col("page")
    if by_listing:
        page = F.coalesce("_page", "page")
        values["offerUrl"] = F.coalesce("_url", "offerUrl")
        values["offerId"] = F.coalesce(offer_id(F.col("_url")), F.when(F.col("_url").isNull(), F.col("offerId")))
    return merged.select(
        page.alias("page"),
        *[values.get(f.name, F.col(f.name)).alias(f.name) for f in OFFER_DETAILED],
        *[F.col("_" + c).alias(c) for c in carry],
    )


def entry_name(key: tuple[str, ...], content: list[str]) -> Column:
    """What tells a row from others: its key, or all that it holds if a part of the key is missing."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
    return F.when(known, F.concat(F.lit("k"), F.to_json(F.struct(*key)))).otherwise(
        F.concat(F.lit("c"), F.sha2(F.to_json(F.struct(*content)), 256))
    )


def only_new(rows: DataFrame, prior: DataFrame, key: tuple[str, ...],
             order: tuple[str, ...] = ()) -> DataFrame:
    """Rows whose key is not in earlier output, one per key.

    Both sides are reduced to one row per key before they meet (the earlier
    output to its key columns only), so repeated keys are gone by map-side
    aggregation and the join reuses the partitioning of the aggregates. Rows
    with a NULL in their key are told apart by all that they hold, and only an equal earlier row makes them old.
    """
    shared = [c for c in rows.columns if c in prior.columns and c != "metadata"]
    seen = prior.select(entry_name(key, shared).alias("_name"))
    return unseen(rows, seen, key, shared, order)


def unseen(rows: DataFrame, seen: DataFrame, key: tuple[str, ...], content: list[str],
           order: tuple[str, ...] = ()) -> DataFrame:
    """Rows whose ``entry_name`` is not in ``seen`` (column ``_name``), one per key. Rows without a key all stay."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
    pick = F.struct(*order) if order else F.struct(*[c for c, t in rows.dtypes if "map<" not in t])
    fresh = (
        rows.filter(known).groupBy(entry_name(key, content).alias("_name"))
        .agg(F.min_by(F.struct(*rows.columns), pick).alias("_row"))
    )
    seen = seen.distinct()
    new = fresh.join(seen, "_name", "left_anti").select("_row.*")
    keyless = rows.filter(~known).withColumn("_name", entry_name(key, content))
    return new.unionByName(keyless.join(seen, "_name", "left_anti").drop("_name"))


def frontier_gap(needed: DataFrame, captured: DataFrame) -> DataFrame:
    """Frontier rows no captured page answers, one per canonical URL.

    A page answers under the URL asked for and under the one it was loaded from.
    """
    wanted = (
        needed.withColumn("_key", url_key(F.col("url")))
        .filter(F.col("_key").isNotNull())
        .groupBy("_key")
        .agg(F.min(F.struct(*needed.columns)).alias("_row"))
    )
    have = (
        captured.select(F.explode(F.array("page.url", "page.loaded_url")).alias("u"))
        .select(url_key(F.col("u")).alias("_key"))
        .filter(F.col("_key").isNotNull())
        .distinct()
    )
    return wanted.join(have, "_key", "left_anti").select("_row.*")


def dataset_counts(datasets: dict[str, DataFrame], **tests: Column) -> DataFrame:
    """Rows per dataset kind: (kind, rows), and how many of them pass each of ``tests``."""
    parts = [
        df.agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.count_if(test).alias(name) for name, test in tests.items()],
        ).select(F.lit(kind).alias("kind"), "rows", *tests)
        for kind, df in datasets.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def offer_filters(filters: OfferFilters, field: Callable[[str], Column],
                  as_of: Column | None = None, detailed: bool = True) -> Column:
    """User filters as one predicate on an offer, read through ``field``.

    Keywords: any of the comma-separated words in any text field. Salary: the
    best offered value is high enough in the asked period. Age counts back from
    ``as_of`` (default: today). Remote work is no field of the page; it is known
    from the listing's own URL parameter, and so is the age of offers that aren't ``detailed``. The contract is
    only known of ``detailed`` offers.
    """
    tests = [F.lit(True)]
    if filters.query is not None:
        words = [w.strip().lower() for w in filters.query.split(",") if w.strip()]
        names = SEARCHED + (SEARCHED_DETAILED if detailed else ())
        text = F.lower(F.concat_ws("\n", *[field(n) for n in names]))
        if words:
            tests.append(reduce(lambda a, b: a | b, [text.contains(w) for w in words]))
    if filters.min_salary is not None:
        best = F.coalesce(field("salaryRangeUpper"), field("salaryRangeLower"))
        tests.append(
            (best >= filters.min_salary) & (field("salaryPeriod") == filters.salary_period)
        )
    if filters.employment_type is not None and detailed:
        tests.append(F.array_contains(field("employmentTypes"), filters.employment_type))
    if filters.last_n_days is not None and not detailed:
        # a card has no day; the listing's URL says how far back it was asked to go
        asked = get_query_param(field("listingUrl"), "count_days").try_cast("int")
        tests.append(F.coalesce(asked <= filters.last_n_days, F.lit(False)))
    if filters.last_n_days is not None and detailed:
        day = F.current_date() if as_of is None else as_of
        tests.append(
            field("datePosted").try_cast("date") >= F.date_sub(day, filters.last_n_days)
        )
    if filters.remote_type is not None:
        tests.append(
            get_query_param(field("listingUrl"), "remote_work") == REMOTE_CODES[filters.remote_type]
        )
    return reduce(lambda a, b: a & b, tests)


def filter_cards(pages: DataFrame, filters: OfferFilters, detailed: bool = False) -> DataFrame:
    """User filters on the entries of listing pages, before any limit counts them.

    Of a ``detailed`` offer only the listing's URL stays as the card has it, so only what it
    answers is tested here.
    """
    if detailed:
        filters = OfferFilters(remote_type=filters.remote_type)
    elif filters.employment_type is not None:
        warnings.warn("employment_type is on detail pages only; a simple run doesn't test it", stacklevel=2)
    if filters == OfferFilters():
        return pages
    kept = F.filter("entries", lambda e: offer_filters(filters, lambda f: e[f], detailed=False))
    return pages.withColumn("entries", kept).withColumn("n", F.size("entries"))
