"""Privacy, run metadata, row rules and user hooks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetables.functions.urls import host_of, is_http_url
from pagetables.params import RunParams
from pagetables.schemas import DESCRIPTION_FIELDS, METADATA
from pagetables.spec import EMPLOYMENT_PHRASES, PRIVACY_OPTION, REDACTED_TEXT


def redact(df: DataFrame, fields: tuple[str, ...], include_personal_data: bool = False,
           option: str = PRIVACY_OPTION) -> DataFrame:
    """Mask private fields unless personal data was asked for.

    Missing values stay missing; a masked array keeps its type with one masked
    text in it, or stays empty.
    """
    if include_personal_data:
        return df
    masked = {}
    for name in fields:
        if name not in df.columns:
            continue
        text = F.lit(REDACTED_TEXT.format(field=name, option=option))
        if isinstance(df.schema[name].dataType, T.ArrayType):
            masked[name] = F.when(F.size(name) > 0, F.array(text)).otherwise(F.col(name))
        else:
            masked[name] = F.when(F.col(name).isNotNull(), text)
    return df.withColumns(masked)


def with_metadata(df: DataFrame, params: RunParams) -> DataFrame:
    """Add the ``metadata`` struct of the page each row came from."""
    page = F.col("page")
    run_id = F.coalesce(page["run_id"], F.lit(params.run_id).cast("string"))
    values = {
        "actorId": F.lit(params.actor_id),
        "actorRunId": run_id,
        "actorRunUrl": F.lit(params.run_url),
        "contextId": F.md5(F.concat_ws("/", run_id, page["page_id"])),
        "requestId": page["page_id"],
        "originalUrl": page["url"],
        "loadedUrl": F.coalesce(page["loaded_url"], page["url"]),
        "dateHandled": page["fetched_at"],
        "numberOfRetries": F.coalesce(page["retries"], F.lit(0)),
    }
    return df.withColumn(
        "metadata",
        F.struct(*[values[f.name].cast(f.dataType).alias(f.name) for f in METADATA]),
    )


def user_hooks(df: DataFrame, transform: Callable[[DataFrame], DataFrame] | None = None,
               keep_if: str | None = None) -> DataFrame:
    """The user's own transformation and SQL filter on a dataset."""
    if transform is not None:
        df = df.transform(transform)
    return df if keep_if is None else df.filter(F.expr(keep_if))


@dataclass(frozen=True)
class Rule:
    """``broken`` gives a true column for a value that breaks the rule."""

    field: str
    name: str
    broken: Callable[[Column], Column]


def int_not_negative(field: str) -> Rule:
    return Rule(field, "int_not_negative", lambda c: c < 0)


def not_empty(field: str) -> Rule:
    return Rule(field, "not_empty", lambda c: c == "")


def required(field: str) -> Rule:
    return Rule(field, "required", lambda c: c.isNull())


def http_url(field: str) -> Rule:
    return Rule(field, "http_url", lambda c: ~is_http_url(c))


def site_url(field: str, tld: str = "sk", fewest: int = 2, most: int = 3) -> Rule:
    """http(s) URL in one top-level domain with a limited number of host labels."""

    def broken(c: Column) -> Column:
        labels = F.split(host_of(c), r"\.")
        fits = F.size(labels).between(fewest, most) & (F.element_at(labels, -1) == tld)
        return ~(is_http_url(c) & fits)

    return Rule(field, "site_url", broken)


def one_of(field: str, *allowed: str) -> Rule:
    return Rule(field, "one_of", lambda c: ~c.isin(*allowed))


def items_one_of(field: str, *allowed: str) -> Rule:
    return Rule(field, "items_one_of", lambda c: F.exists(c, lambda x: ~x.isin(*allowed)))


def items_not_empty(field: str) -> Rule:
    return Rule(field, "items_not_empty",
                lambda c: F.exists(c, lambda x: x.isNull() | (x == "")))


def texts_not_empty(field: str) -> Rule:
    """Array items may be missing but not empty."""
    return Rule(field, "texts_not_empty", lambda c: F.exists(c, lambda x: x.eqNullSafe("")))


def min_items(field: str, n: int) -> Rule:
    return Rule(field, "min_items", lambda c: F.size(c) < n)


def categories_not_empty(field: str) -> Rule:
    return Rule(field, "categories_not_empty", lambda c: F.exists(
        c, lambda x: x["url"].eqNullSafe("") | x["name"].eqNullSafe("")))


def iso_date(field: str) -> Rule:
    iso = r"^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"
    return Rule(field, "iso_date", lambda c: ~(
        c.rlike(iso) & F.substring(c, 1, 10).try_cast("date").isNotNull()))


def rules_for(kind: str, detailed: bool = False, tld: str = "sk",
              custom_design: bool = False) -> list[Rule]:
    """Row rules of a dataset kind. Values may be NULL unless ``required``."""
    if kind == "jobOffers":
        rules = [
            site_url("listingUrl", tld), not_empty("employerName"), site_url("employerUrl", tld),
            not_empty("employerLogoUrl"), not_empty("offerName"), site_url("offerUrl", tld),
            not_empty("offerId"), not_empty("salaryRange"), int_not_negative("salaryRangeLower"),
            int_not_negative("salaryRangeUpper"), not_empty("salaryCurrency"),
            not_empty("salaryPeriod"), not_empty("location"), texts_not_empty("labels"),
            not_empty("lastChangeRelativeTime"), not_empty("lastChangeType"),
        ]
        if detailed:
            rules += [
                items_one_of("employmentTypes", *EMPLOYMENT_PHRASES), not_empty("startDate"),
                items_not_empty("phoneNumbers"), iso_date("datePosted"),
                categories_not_empty("locationCategs"), categories_not_empty("professionCategs"),
                *[not_empty(f) for f in DESCRIPTION_FIELDS],
            ]
            if not custom_design:
                rules += [min_items("employmentTypes", 1), required("startDate")]
        return rules
    if kind == "partners":
        return [
            not_empty("name"), required("url"), http_url("url"), not_empty("description"),
            site_url("logoUrl", tld), not_empty("category"),
        ]
    rules = [
        required("name"), not_empty("name"), required("url"), site_url("url", tld),
        required("count"), int_not_negative("count"),
    ]
    if kind == "locations":
        rules += [not_empty("region"), required("country"), not_empty("country")]
    return rules


def metadata_rules() -> list[Rule]:
    """Rules of the ``metadata`` column all datasets carry."""
    return [
        not_empty("metadata.actorId"), not_empty("metadata.actorRunId"),
        http_url("metadata.actorRunUrl"), required("metadata.contextId"),
        not_empty("metadata.contextId"), not_empty("metadata.requestId"),
        http_url("metadata.originalUrl"), http_url("metadata.loadedUrl"),
        int_not_negative("metadata.numberOfRetries"),
    ]


def _broken(rule: Rule) -> Column:
    return F.coalesce(rule.broken(F.col(rule.field)), F.lit(False))


def violations(df: DataFrame, rules: list[Rule], key: list[str]) -> DataFrame:
    """One row per broken rule: the row's key, the rule and the field. One pass."""
    found = F.array_compact(F.array(*[
        F.when(_broken(r), F.struct(F.lit(r.name).alias("rule"), F.lit(r.field).alias("field")))
        for r in rules
    ]))
    return df.select(*key, F.explode(found).alias("_v")).select(*key, "_v.*")


def violation_counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(rule, field, violations) for every rule, zero included.

    One scan with one partial aggregate row per task, whatever the number of rules.
    """
    sums = df.agg(*[F.count_if(_broken(r)).alias(f"_{i}") for i, r in enumerate(rules)])
    counts = F.array(*[
        F.struct(
            F.lit(r.name).alias("rule"), F.lit(r.field).alias("field"),
            F.col(f"_{i}").alias("violations"),
        )
        for i, r in enumerate(rules)
    ])
    return sums.select(F.inline(counts))


def validate_rows(df: DataFrame, rules: list[Rule], mode: str = "flag") -> DataFrame:
    """Apply row rules: ``flag`` adds ``violated`` names, ``drop`` removes such
    rows, ``fail`` ends the job at the first one."""
    names = F.array_compact(F.array(*[
        F.when(_broken(r), F.lit(f"{r.name}({r.field})")) for r in rules
    ]))
    if mode == "flag":
        return df.withColumn("violated", names)
    any_broken = reduce(lambda a, b: a | b, [_broken(r) for r in rules])
    if mode == "drop":
        return df.filter(~any_broken)
    if mode == "fail":
        message = F.concat(F.lit("row rules broken: "), F.array_join(names, ", "))
        return df.filter(F.when(any_broken, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    raise ValueError(f"mode must be flag, drop or fail, got {mode!r}")
