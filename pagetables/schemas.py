"""Declared schemas: captured pages, the columnar DOM and the typed datasets.

Nothing in the engine infers a schema; readers and writers use these.
"""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _I = T.StringType(), T.LongType(), T.IntegerType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


#: One row per captured page. Only page_id, url and html are needed; readers
#: fill the others with NULL.
PAGES = _struct(
    ("page_id", _L),
    ("url", _S),
    ("loaded_url", _S),
    ("html", _S),
    ("fetched_at", T.TimestampType()),
    ("retries", _I),
    ("run_id", _S),
    ("list_page_num", _I),
)

#: One element of a page. ``nodes`` is an array of these in document order, so
#: the array position equals ``id`` and a subtree is the slice ``id..last``.
#: ``text`` is the text before the first child, ``tail`` the text between the
#: element's end and the next tag. ``classes`` is the class attribute with one
#: blank around each name (" a b "), so a class test is a plain text search.
#: Node 0 is a synthetic root around the page.
NODE = _struct(
    ("id", _I),
    ("last", _I),
    ("parent", _I),
    ("nth", _I),
    ("tag", _S),
    ("el_id", _S),
    ("classes", _S),
    ("attrs", T.MapType(_S, _S, False)),
    ("text", _S),
    ("tail", _S),
)
NODES = T.ArrayType(NODE, False)

METADATA = _struct(
    ("actorId", _S),
    ("actorRunId", _S),
    ("actorRunUrl", _S),
    ("contextId", _S),
    ("requestId", _S),
    ("originalUrl", _S),
    ("loadedUrl", _S),
    ("dateHandled", T.TimestampType()),
    ("numberOfRetries", _I),
)

CATEGORY = _struct(("url", _S), ("name", _S))

OFFER_SIMPLE = _struct(
    ("listingUrl", _S),
    ("employerName", _S),
    ("employerUrl", _S),
    ("employerLogoUrl", _S),
    ("offerName", _S),
    ("offerUrl", _S),
    ("offerId", _S),
    ("location", _S),
    ("labels", T.ArrayType(_S)),
    ("lastChangeRelativeTime", _S),
    ("lastChangeType", _S),
    ("salaryRange", _S),
    ("salaryRangeLower", _L),
    ("salaryRangeUpper", _L),
    ("salaryCurrency", _S),
    ("salaryPeriod", _S),
)

DESCRIPTION_FIELDS = (
    "jobInfoResponsibilities",
    "jobInfoBenefits",
    "jobInfoDeadline",
    "jobReqEducation",
    "jobReqExpertise",
    "jobReqLanguage",
    "jobReqOther",
    "jobReqDriversLicense",
    "jobReqIndustry",
    "jobReqSuitableForGraduate",
    "jobReqPersonalSkills",
    "employerDescription",
    "employeeCount",
    "employerContact",
)

OFFER_DETAILED = T.StructType(
    OFFER_SIMPLE.fields
    + _struct(
        ("employmentTypes", T.ArrayType(_S)),
        ("startDate", _S),
        ("phoneNumbers", T.ArrayType(_S)),
        ("datePosted", _S),
        ("locationCategs", T.ArrayType(CATEGORY)),
        ("professionCategs", T.ArrayType(CATEGORY)),
        *((f, _S) for f in DESCRIPTION_FIELDS),
    ).fields
)

LINK_LIST = _struct(("url", _S), ("name", _S), ("count", _L))
LOCATIONS = T.StructType(
    LINK_LIST.fields + _struct(("region", _S), ("country", _S)).fields
)
PARTNERS = _struct(
    ("name", _S), ("url", _S), ("description", _S), ("logoUrl", _S), ("category", _S)
)

FRONTIER = _struct(
    ("url", _S),
    ("label", _S),
    ("listing_page_num", _I),
    ("parent_url", _S),
    ("reason", _S),
)
REJECTED = _struct(("url", _S), ("route", _S), ("reason", _S))


def dataset_schema(kind: str, detailed: bool = False) -> T.StructType:
    """Row schema of a dataset kind, without the metadata column."""
    if kind == "jobOffers":
        return OFFER_DETAILED if detailed else OFFER_SIMPLE
    if kind == "locations":
        return LOCATIONS
    if kind == "partners":
        return PARTNERS
    if kind in ("companies", "industries", "professions", "languages"):
        return LINK_LIST
    raise ValueError(f"unknown dataset kind: {kind}")
