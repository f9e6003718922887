"""Job offer detail pages."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.functions.arrays import built_once, drop_empty, fill_headings, let, pairs
from pagetables.functions.dom import Dom
from pagetables.functions.text import codes_in_text, offer_id, parse_salary
from pagetables.functions.urls import resolve_against, split_url
from pagetables.schemas import CATEGORY, DESCRIPTION_FIELDS, OFFER_DETAILED
from pagetables.spec import (
    DESCRIPTION_PHRASES, EMPLOYMENT_PHRASES, LOCATION_HEADING, PROFESSION_HEADING, SiteSpec,
)


def detail_basic(dom: Dom, entry: Column, base: Column, spec: SiteSpec,
                 keep_base_query: bool = False) -> dict[str, Column]:
    """Title, employer, contract and contact fields of the offer block."""
    css, dom = spec.detail, Dom(dom.nodes, box=entry)

    def text(name: str) -> Column:
        return dom.text(dom.find(css[name]))

    def link(name: str, attr: str) -> Column:
        return resolve_against(base, dom.attr(dom.find(css[name]), attr), keep_base_query)

    return {
        "offerName": text("title"),
        "employerName": text("employer"),
        "employerUrl": link("employer_link", "href"),
        "employerLogoUrl": link("logo", "src"),
        "employmentTypes": codes_in_text(text("employment"), EMPLOYMENT_PHRASES),
        "startDate": text("start"),
        "location": text("location"),
        "phoneNumbers": dom.texts(dom.find_all(css["phone"])),
        "datePosted": text("posted"),
    }


def detail_sections(dom: Dom, entry: Column, spec: SiteSpec) -> Column:
    """Per description section its (title, content) texts, as one struct.

    Titles and contents alternate among the section's children once its first
    subtitle is taken out. Side notes are left out of the contents.
    """
    css = spec.detail
    return dom.scoped([css["section_title"], css["aside"]], lambda d: _sections_of(d, entry, spec))


def _sections_of(dom: Dom, entry: Column, spec: SiteSpec) -> Column:
    css = spec.detail

    def section_pairs(selector: str) -> Column:
        section = Dom(dom.nodes, box=entry).find(selector)
        return let(section, lambda s: F.when(s.isNotNull(), let(
            dom.find(css["section_title"], s),
            lambda sub: F.transform(
                pairs(F.filter(
                    dom.children(s), lambda c: ~(c["id"].eqNullSafe(sub["id"]))
                )),
                lambda p: F.struct(
                    dom.text_lower(p["first"], without=F.array(sub)).alias("title"),
                    dom.text(
                        p["second"],
                        without=F.concat(
                            F.array(sub),
                            F.coalesce(dom.find_all(css["aside"], p["second"]), F.array()),
                        ),
                    ).alias("content"),
                ),
            ),
        )))

    return F.struct(*[
        section_pairs(s).alias(s.lstrip(".").replace("-", "_")) for s in DESCRIPTION_PHRASES
    ])


def _titled(phrases: tuple[str, ...]) -> Callable[[Column], Column]:
    return lambda p: reduce(lambda a, b: a | b, [p["title"].contains(x) for x in phrases])


def detail_description(sections: Column) -> dict[str, Column]:
    """Description texts by title phrase.

    A title may feed several fields of its section, and the last matching pair
    wins even when its content is empty.
    """
    fields = {}
    for selector, subsections in DESCRIPTION_PHRASES.items():
        found = sections[selector.lstrip(".").replace("-", "_")]
        for name, phrases in subsections.items():
            named = F.filter(found, _titled(phrases))
            fields[name] = F.try_element_at(named, F.lit(-1))["content"]
    return {name: fields[name] for name in DESCRIPTION_FIELDS}


def detail_categories(dom: Dom, entry: Column, base: Column, spec: SiteSpec,
                      keep_base_query: bool = False) -> Column:
    """Category links with the lowercased heading above each, in page order."""
    items = F.filter(
        dom.children(Dom(dom.nodes, box=entry).find(spec.detail["categories"])),
        lambda n: n["tag"].isin("strong", "a"),
    )
    return let(items, lambda kids: F.when(F.size(kids) > 0, F.filter(
        fill_headings(
            kids,
            is_heading=lambda n: n["tag"] == "strong",
            heading=lambda n: dom.text_lower(n),
            build=lambda n, title: F.struct(
                (n["tag"] == "a").alias("is_link"),
                title.alias("heading"),
                resolve_against(base, dom.attr(n, "href"), keep_base_query).alias("url"),
                dom.text(n).alias("name"),
            ),
        ),
        lambda c: c["is_link"],
    )))


def _under(categories: Column, phrase: str) -> Column:
    links = F.transform(
        F.filter(categories, lambda c: c["heading"].contains(phrase)),
        lambda c: F.struct(c["url"].alias("url"), c["name"].alias("name")),
    )
    return F.coalesce(links, F.array().cast(f"array<{CATEGORY.simpleString()}>"))


def job_details(shredded: DataFrame, spec: SiteSpec, keep_base_query: bool = False) -> DataFrame:
    """Detail pages -> one detailed row each, with empty listing fields. No shuffle."""
    box, entry, sections, categories, pay = _detail_parts(spec, keep_base_query)
    found = (
        shredded.filter(F.col("route") == "jobDetail")
        .withColumns({"_base": split_url(F.col("effective_url")), "_box": box})
        .withColumn("_entry", entry)
        .withColumns({"_sections": sections, "_categories": categories, "_pay": pay})
    )
    keep = [c for c in shredded.columns if c != "nodes"]
    return found.select(*keep, *_detail_fields(spec, keep_base_query))


@built_once
def _detail_parts(spec: SiteSpec, keep_base_query: bool) -> tuple[Column, ...]:
    dom, css, entry = Dom("nodes"), spec.detail, F.col("_entry")
    return (
        dom.find(css["container"]),
        dom.find(css["entry"], F.col("_box")),
        detail_sections(dom, entry, spec),
        detail_categories(dom, entry, F.col("_base"), spec, keep_base_query),
        parse_salary(dom.text(Dom("nodes", box=entry).find(css["salary"]))),
    )


@built_once
def _detail_fields(spec: SiteSpec, keep_base_query: bool) -> tuple[Column, ...]:
    dom, url, css = Dom("nodes"), F.col("effective_url"), spec.detail
    fields = {
        **detail_basic(dom, F.col("_entry"), F.col("_base"), spec, keep_base_query),
        **{f: F.col("_pay")[f] for f in (
            "salaryRange", "salaryRangeLower", "salaryRangeUpper", "salaryCurrency",
            "salaryPeriod")},
        **detail_description(F.col("_sections")),
        "locationCategs": _under(F.col("_categories"), LOCATION_HEADING),
        "professionCategs": _under(F.col("_categories"), PROFESSION_HEADING),
        "offerUrl": url,
        "offerId": offer_id(url),
        "labels": drop_empty(F.transform(
            Dom("nodes", box=F.col("_box")).find_all(css["label"]), lambda n: dom.text_lower(n)
        )),
    }
    return tuple(
        fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in OFFER_DETAILED
    )
