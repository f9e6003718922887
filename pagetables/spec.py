"""Site knowledge as data: routes, selectors, phrases and codes.

Operators take a ``SiteSpec`` and hold no site facts themselves. ``job_board``
gives the spec of a Slovak job board for a given host name.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

# --- fixed values of the job board ------------------------------------------
DATASET_KINDS = (
    "jobOffers", "industries", "professions", "companies", "languages", "locations", "partners",
)
EMPLOYMENT_PHRASES = {
    "fte": "plný úväzok",
    "pte": "skrátený úväzok",
    "selfemploy": "živnosť",
    "voluntary": "na dohodu (brigády)",
    "internship": "internship, stáž",
}
EMPLOYMENT_PATHS = {
    "fte": "plny-uvazok",
    "pte": "skrateny-uvazok",
    "selfemploy": "zivnost",
    "voluntary": "na-dohodu-brigady",
    "internship": "internship-staz",
}
REMOTE_CODES = {"fullRemote": "1", "partialRemote": "2", "noRemote": "0"}
PERIOD_CODES = {"month": "m", "hour": "h"}
LIST_PATHS = {
    "industries": "zoznam-pracovnych-oblasti",
    "professions": "zoznam-pozicii",
    "companies": "zoznam-spolocnosti",
    "locations": "zoznam-lokalit",
    "languages": "zoznam-jazykovych-znalosti",
}
DESCRIPTION_PHRASES = {
    ".job-info": {
        "jobInfoResponsibilities": ("náplň práce", "právomoci", "zodpovednosti"),
        "jobInfoBenefits": ("výhody", "benefity"),
        "jobInfoDeadline": ("termín", "ukončenia", "výberového konania"),
    },
    ".job-requirements": {
        "jobReqEducation": ("vzdelaním",),
        "jobReqExpertise": ("vzdelanie v odbore",),
        "jobReqLanguage": ("jazykové",),
        "jobReqOther": ("ostatné",),
        "jobReqDriversLicense": ("vodičský",),
        "jobReqIndustry": ("pozícii", "v oblasti"),
        "jobReqSuitableForGraduate": ("absolventa",),
        "jobReqPersonalSkills": ("osobnostné", "predpoklady", "zručnosti"),
    },
    ".company-info": {
        "employerDescription": ("charakteristika spoločnosti",),
        "employeeCount": ("počet zamestnancov",),
        "employerContact": ("kontakt",),
    },
}
LISTING_SELECTORS = {
    "row": ".list-row:not(.native-agent):not(.reach-list)",
    "employer": ".employer",
    "logo_link": ".offer-company-logo-link",
    "logo": ".offer-company-logo-link img",
    "link": "h2 a",
    "location": ".job-location",
    "salary": '.label-group > a[data-dimension7="Salary label"]',
    "label": '.label-group > a:not([data-dimension7="Salary label"])',
    "footer": ".list-footer .info",
    "change_time": "strong",
    "counter": ".offer-counter",
}
DETAIL_SELECTORS = {
    "container": "#content .container",
    "entry": "#detail .card-content",
    "label": ".label",
    "title": '[itemprop="title"]',
    "employer": '[itemprop="hiringOrganization"]',
    "employer_link": ".easy-design-btn-offer-list",
    "logo": ".easy-design-logo img",
    "salary": ".salary-range",
    "employment": '[itemprop="employmentType"]',
    "start": ".panel-body > .row:nth-child(2) > div:nth-child(1) span",
    "location": '[itemprop="jobLocation"]',
    "phone": ".details-section .tel",
    "posted": '[itemprop="datePosted"]',
    "section_title": ".subtitle-line",
    "aside": ".text-gray",
    "categories": ".overall-info .hidden-xs",
}
LINK_SELECTORS = {
    "title": "h1", "tab": ".nav-tabs a", "link": ".card a", "heading": "h2", "count": "span",
}
PARTNER_SELECTORS = {
    "tab": ".nav-tabs a", "card": ".tab-content .card", "row": ".row",
    "logo": "img", "info": "div:nth-child(2)", "link": "a",
}
CUSTOM_DESIGN = "body.listing.custom-design"
STANDARD_DESIGN = "body.listing:not(.custom-design)"
ADDED_PHRASE = "pridané"
HOME_COUNTRY = "Slovenská republika"
LOCATION_HEADING = "lokalit"
PROFESSION_HEADING = "pozícia"
ROWS_PER_PAGE = 20
PRIVATE_FIELDS = ("employerContact", "phoneNumbers")
PRIVACY_OPTION = "Include personal data"
REDACTED_TEXT = (
    '<Redacted property "{field}". To include the actual value,'
    ' toggle ON the Actor input option "{option}">'
)
# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Route:
    """A page gets ``label`` when every ``all_of`` pattern and any ``any_of``
    pattern is found in its URL and, if given, ``page`` selects something in it."""

    label: str
    all_of: tuple[str, ...]
    any_of: tuple[str, ...] = ()
    page: str | None = None


@dataclass(frozen=True, eq=False)
class SiteSpec:
    """One object per site; compared by identity, so build it once and pass it on."""

    host: str
    routes: tuple[Route, ...]
    seeds: dict[str, str]
    list_kinds: dict[str, str]  # dataset kind -> URL pattern
    unsupported: dict[str, str]  # route -> reason
    listing: dict[str, str] = field(default_factory=lambda: dict(LISTING_SELECTORS))
    detail: dict[str, str] = field(default_factory=lambda: dict(DETAIL_SELECTORS))
    links: dict[str, str] = field(default_factory=lambda: dict(LINK_SELECTORS))
    partners: dict[str, str] = field(default_factory=lambda: dict(PARTNER_SELECTORS))


def job_board(host: str) -> SiteSpec:
    """Spec of the job board served at ``host``, with routes in match order."""
    site = rf"(?i)\W{re.escape(host)}"
    end = r"/?(?:[?#~]|$)"
    offers = rf"{site}/praca/"
    company = (r"/praca/.*?/C[0-9]{2,}", r"company_id=[0-9]{2,}")
    seeds = {"jobOffers": f"https://{host}/praca"}
    seeds.update({k: f"https://www.{host}/praca/{p}" for k, p in LIST_PATHS.items()})
    seeds["partners"] = f"https://www.{host}/partneri"
    return SiteSpec(
        host=host,
        routes=(
            Route("mainPage", (site + end,)),
            Route("jobDetail", (offers, r"/praca/.*?/O[0-9]{2,}")),
            Route("companyDetailCustom", (offers,), company, page=CUSTOM_DESIGN),
            Route("jobRelatedList", (rf"{site}/praca/zoznam-[a-z0-9-]+{end}",)),
            Route("jobListing", (offers,), company, page=STANDARD_DESIGN),
            Route("jobListing", (offers,)),
            Route("partners", (rf"{site}/partneri{end}",)),
        ),
        seeds=seeds,
        list_kinds={k: rf"{site}/praca/{p}" for k, p in LIST_PATHS.items()},
        unsupported={"companyDetailCustom": "custom-design company page"},
    )
