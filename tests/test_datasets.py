import pytest
from pyspark.sql import functions as F

import pages as T
from pagetables.operators import govern as G
from pagetables.operators import routing as Ro
from pagetables.params import OfferFilters, RunParams
from pagetables.plans import datasets as P
from pagetables.schemas import dataset_schema
from pagetables.sources.pages import captured
from pagetables.spec import job_board

SPEC = job_board(T.HOST)


@pytest.fixture(scope="module")
def pages(spark):
    return captured(spark.createDataFrame(T.ROWS, "page_id long, url string, html string")).coalesce(2)


def run(pages, **options):
    return [r.asDict(recursive=True) for r in P.run_dataset(pages, SPEC, RunParams(**options)).collect()]


def test_simple_offers(pages):
    rows = run(pages, dataset="jobOffers")
    assert [r["offerName"] for r in rows] == ["Offer name", "No link"]
    first = rows[0]
    assert first["listingUrl"] == T.SITE + "/praca/?page_num=5"
    assert first["employerUrl"] == T.SITE + "/praca/acme/C12345"
    assert first["employerLogoUrl"] == T.SITE + "/logo.png"
    assert (first["offerId"], first["labels"], first["lastChangeType"]) == ("O1234567", ["label"], "added")
    assert (first["salaryRangeLower"], first["salaryRangeUpper"]) == (901, 1231)
    assert first["metadata"]["originalUrl"] == T.SITE + "/praca/?page_num=5"
    assert rows[1]["lastChangeType"] == "modified" and rows[1]["offerUrl"] is None


def test_links_keep_the_page_query_on_request(pages):
    rows = run(pages, dataset="jobOffers", keep_base_query=True)
    assert rows[0]["offerUrl"] == T.SITE + "/praca/acme/O1234567?page_num=5"


def test_detailed_offers_overlay_the_card(pages):
    rows = run(pages, dataset="jobOffers", detailed=True)
    assert len(rows) == 1
    row = rows[0]
    # the detail page wins even where it has nothing
    assert row["employerName"] is None and row["offerName"] == "T" and row["location"] == "L"
    assert row["lastChangeRelativeTime"] == "pred 4 minútami"
    assert row["employmentTypes"] == ["fte", "selfemploy"] and row["startDate"] == "Dohodou"
    assert row["labels"] == ["label"]
    # last matching pair wins, even without text; side notes are left out
    assert row["jobInfoResponsibilities"] == "text" and row["jobInfoBenefits"] is None
    # one title may feed several fields, an odd title has no content
    assert row["jobReqEducation"] == row["jobReqIndustry"] == "VŠ" and row["jobReqOther"] is None
    assert row["locationCategs"] == [{"url": T.SITE + "/l1", "name": "L1"}]
    assert row["professionCategs"] == [{"url": T.SITE + "/praca/acme/p1", "name": "P1"}]
    assert row["phoneNumbers"][0].startswith('<Redacted property "phoneNumbers"')
    opened = run(pages, dataset="jobOffers", detailed=True, include_personal_data=True)
    assert opened[0]["phoneNumbers"] == ["+421"]


def test_locations_by_tab(pages):
    rows = run(pages, dataset="locations")
    home = [(r["name"], r["count"], r["region"]) for r in rows if r["country"] == "Slovenská republika"]
    assert home == [("Z", 3, None), ("Region", 7966, "Region"), ("Same parent", 3, "Region"), ("District", 12, "Region")]
    away = [(r["name"], r["region"], r["country"]) for r in rows if r["country"] != "Slovenská republika"]
    assert away == [("Z", None, None), ("Region", None, "Region"), ("Same parent", None, "Region"), ("District", None, "Region")]


def test_partners(pages):
    rows = run(pages, dataset="partners")
    assert [(r["name"], r["category"], r["description"], r["logoUrl"]) for r in rows] == [
        ("Name", "Category 1", "description", T.SITE + "/l.png"), ("Q", None, None, None)]


def test_count_only_gives_no_rows_but_the_total(pages):
    assert run(pages, dataset="jobOffers", count_only=True) == [{"listing": T.SITE + "/praca/", "total": 20345}]


def test_limits_filters_and_hooks(pages):
    assert len(run(pages, dataset="jobOffers", max_entries=1)) == 1
    assert len(run(pages, dataset="jobOffers", max_entries=0)) == 0
    assert [r["name"] for r in run(pages, dataset="locations", max_entries=2)] == ["Z", "Region"]
    rows = run(pages, dataset="jobOffers", filters=OfferFilters(query="no link, other"), max_entries=1)
    assert [r["offerName"] for r in rows] == ["No link"]
    rows = run(pages, dataset="partners", keep_if="name = 'n'",
               transform=lambda df: df.withColumn("name", F.lower(F.substring("name", 1, 1))))
    assert [r["name"] for r in rows] == ["n"]


def test_only_new_entries(pages, spark):
    prior = P.run_dataset(pages, SPEC, RunParams(dataset="partners")).filter("name = 'Q'")
    fresh = P.run_dataset(pages, SPEC, RunParams(dataset="partners"), prior=prior)
    assert [r.name for r in fresh.collect()] == ["Name"]


def test_schemas_are_as_declared(pages):
    for kind, detailed in [("jobOffers", False), ("jobOffers", True), ("locations", False), ("partners", False)]:
        df = P.run_dataset(pages, SPEC, RunParams(dataset=kind, detailed=detailed)).drop("metadata")
        want = dataset_schema(kind, detailed)
        assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [
            (f.name, f.dataType.simpleString()) for f in want]


def test_rejected_and_missing_pages(pages):
    assert [tuple(r) for r in P.rejected_pages(pages, SPEC).collect()] == [
        (T.SITE + "/praca/accenture/C3691", "companyDetailCustom", "custom-design company page")]
    gap = P.missing_pages(pages, SPEC, RunParams(dataset="jobOffers", detailed=True)).collect()
    assert {(r.url, r.reason) for r in gap} == {
        (f"https://{T.HOST}/praca", "seed"), (T.SITE + "/praca/?page_num=6", "next page")}
    tabs = P.missing_pages(pages, SPEC, RunParams(dataset="locations")).filter("reason = 'list tab'").collect()
    assert T.SITE + "/praca/zoznam-lokalit/?tab_index=0" in {r.url for r in tabs}


def test_rows_pass_their_rules(pages):
    rows = P.run_dataset(pages, SPEC, RunParams(dataset="jobOffers", detailed=True))
    assert G.violations(rows, G.rules_for("jobOffers", True) + G.metadata_rules(), ["offerId"]).count() == 0
    bad = P.run_dataset(pages, SPEC, RunParams(dataset="locations"))
    assert G.validate_rows(bad, G.rules_for("locations"), "drop").count() == 7
    flagged = G.validate_rows(bad, G.rules_for("locations")).filter("size(violated) > 0").collect()
    assert [r.violated for r in flagged] == [["required(country)"]]
    with pytest.raises(Exception, match="row rules broken"):
        G.validate_rows(bad, G.rules_for("locations"), "fail").collect()


@pytest.mark.parametrize("url, label", [
    (T.SITE, "mainPage"), (T.SITE + "/?#", "mainPage"), (T.SITE + "/praca", None),
    (T.SITE + "/praca/", "jobListing"), (T.SITE + "/praca/okres-pezinok/", "jobListing"),
    (T.SITE + "/praca/komix-sk/O4556386", "jobDetail"), (T.SITE + "/praca/komix-sk/o4556386", "jobListing"),
    (T.SITE + "/praca/a/C201052", "jobListing"), (T.SITE + "/praca/zoznam-pozicii/", "jobRelatedList"),
    (f"https://{T.HOST}/partneri", "partners"), (f"https://x{T.HOST}/partneri", None),
])
def test_routes(spark, url, label):
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(Ro.route(F.col("u"), SPEC)).first()[0] == label


def test_filter_url(spark):
    asked = OfferFilters(query="asis", min_salary=6, min_salary_period="hour", employment_type="fte",
                         remote_type="partialRemote", last_n_days=70)
    df = spark.createDataFrame([(T.SITE + "/praca/",)], "u string")
    from pagetables.functions.urls import sort_url
    got = df.select(sort_url(P.listing_url_with_filters(F.col("u"), asked))).first()[0]
    assert got == T.SITE + "/praca/?count_days=70&remote_work=2&salary=6&salary_period=h&search_anywhere=asis"


@pytest.mark.parametrize("options", [
    {}, {"dataset": "x"}, {"dataset": "partners", "start_urls": ("a",)}, {"dataset": "partners", "max_entries": -1},
])
def test_bad_options(options):
    with pytest.raises(ValueError):
        RunParams(**options)


def test_bad_filters():
    for options in ({"min_salary": -1}, {"remote_type": "x"}, {"employment_type": "x"}, {"min_salary_period": "day"}):
        with pytest.raises(ValueError):
            OfferFilters(**options)


def test_pages_without_a_scheme_are_kept(spark):
    bare = T.SITE.removeprefix("https://")
    rows = [(1, bare + "/praca/", T.LISTING), (2, bare + "/praca/zoznam-lokalit/", T.LINKS), (3, bare + "/partneri", T.PARTNERS)]
    pages = captured(spark.createDataFrame(rows, "page_id long, url string, html string")).coalesce(1)
    assert len(run(pages, dataset="jobOffers", max_entries=5)) == 2
    assert len(run(pages, dataset="locations")) == 4
    assert len(run(pages, dataset="partners")) == 2


def board(spark, *rows):
    return captured(spark.createDataFrame([(k, T.SITE + u, h) for k, (u, h) in enumerate(rows)], "page_id long, url string, html string"))


def cards(*numbers):
    return "".join(f'<div class="list-row"><h2><a href="/praca/acme/O{k}">n{k}</a></h2></div>' for k in numbers)


def test_detail_pages_of_their_own(spark):
    pages = board(spark, ("/praca/acme/O1234567", T.DETAIL), ("/praca/acme/O77", T.DETAIL), ("/praca/", T.LISTING))
    urls = (T.SITE + "/praca/acme/O1234567", T.SITE + "/praca/acme/O77")
    rows = P.run_dataset(pages, SPEC, RunParams(start_urls=urls)).collect()
    assert sorted(r.offerUrl for r in rows) == sorted(urls) and all("jobReqOther" in r for r in rows)
    rows = P.run_dataset(pages, SPEC, RunParams(dataset="jobOffers", detailed=True)).collect()
    assert sorted(r.offerUrl for r in rows) == sorted(urls)  # one with its card, one alone
    both = RunParams(start_urls=(T.SITE + "/praca/", urls[0]))
    assert sorted(r.offerUrl or "" for r in P.run_dataset(pages, SPEC, both).collect()) == ["", urls[0], urls[1]]
    places = RunParams(start_urls=(T.SITE + "/praca/zoznam-lokalit/",))
    assert P.run_dataset(board(spark, ("/praca/zoznam-lokalit/", T.LINKS)), SPEC, places).count() == 4
    with pytest.raises(ValueError, match="several datasets"):
        P.run_dataset(pages, SPEC, RunParams(start_urls=(T.SITE + "/partneri", urls[0])))


def test_filters_of_detailed_runs_see_the_detail_page(spark):
    pages = board(spark, ("/praca/", cards(1234567)), ("/praca/acme/O1234567", T.DETAIL))
    for filters in (OfferFilters(query="vš"), OfferFilters(min_salary=2000)):
        assert P.run_dataset(pages, SPEC, RunParams(dataset="jobOffers", detailed=True, filters=filters)).count() == 1
    nothing = OfferFilters(query="not there")
    assert P.run_dataset(pages, SPEC, RunParams(dataset="jobOffers", detailed=True, filters=nothing)).count() == 0


def test_one_limit_for_all_listings(spark):
    pages = board(spark, ("/praca/a/", cards(1, 2, 3)), ("/praca/b/", cards(4, 5, 6)), ("/praca/b/?page_num=2", cards(7)))
    offers = RunParams(dataset="jobOffers", max_entries=5)
    assert P.run_dataset(pages, SPEC, offers).count() == 5
    assert P.run_dataset(pages, SPEC, offers, existing=4).count() == 1
    asked = {r.url for r in P.missing_pages(pages, SPEC, offers).filter("reason = 'next page'").collect()}
    assert asked == {T.SITE + "/praca/a/?page_num=2"}
    # filtered rows don't use the limit up
    some = RunParams(dataset="jobOffers", max_entries=1, filters=OfferFilters(query="n7"))
    assert [r.offerName for r in P.run_dataset(pages, SPEC, some).collect()] == ["n7"]


def test_unreadable_page_numbers_stay_apart(spark):
    pages = board(spark, ("/praca/?page_num=1", cards(1)), ("/praca/?page_num=abc", cards(2)))
    assert P.run_dataset(pages, SPEC, RunParams(dataset="jobOffers")).count() == 2


def test_lists_without_a_dataset_are_reported(spark):
    pages = board(spark, ("/praca/zoznam-inych-veci/", T.LINKS))
    assert [r.reason for r in P.rejected_pages(pages, SPEC).collect()] == [P.UNKNOWN_LIST]


def test_fan_out_leaves_the_pages_as_they_are(spark, tmp_path):
    pages = board(spark, ("/praca/", cards(1)))
    P.fan_out(pages, SPEC, RunParams(dataset="jobOffers"))
    assert P.run_dataset(pages, SPEC, RunParams(dataset="jobOffers")).count() == 1


def test_profile_page_with_cards_is_a_listing(spark):
    pages = board(spark, ("/praca/acme/C12345", '<body class="listing">' + cards(1, 2)))
    assert P.run_dataset(pages, SPEC, RunParams(dataset="jobOffers")).count() == 2


def test_many_unclosed_tags_are_read_at_once():
    import time

    import pyarrow as pa

    from pagetables.functions.shred import shred_batch

    began = time.time()
    shred_batch(pa.array(["<p>x</p>" + "<a " * 300_000]))
    assert time.time() - began < 2


def test_simple_runs_take_the_age_from_the_listing(spark):
    pages = board(spark, ("/praca/?count_days=7", cards(1)), ("/praca/?count_days=70", cards(2)), ("/praca/", cards(3)))
    params = RunParams(dataset="jobOffers", filters=OfferFilters(last_n_days=7))
    assert [r.offerName for r in P.run_dataset(pages, SPEC, params).collect()] == ["n1"]
    with pytest.warns(UserWarning, match="employment_type"):
        P.run_dataset(pages, SPEC, RunParams(dataset="jobOffers", filters=OfferFilters(employment_type="fte")))


def test_default_ports_are_no_part_of_a_key(spark):
    from pagetables.functions.urls import url_key
    rows = [("https://h:443/a", "https://h/a"), ("http://h:80/", "http://h/"), ("http://h:443/", "http://h:443/"), ("https://h:/x", "https://h/x")]
    df = spark.createDataFrame(rows, "u string, want string")
    assert df.filter(url_key(F.col("u")) != F.col("want")).count() == 0
