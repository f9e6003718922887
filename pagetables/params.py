"""Run options and their checks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from pagetables.spec import DATASET_KINDS, EMPLOYMENT_PHRASES, PERIOD_CODES, REMOTE_CODES


def _one_of(name: str, value: str | None, allowed) -> None:
    if value is not None and value not in allowed:
        raise ValueError(f"{name} must be one of {list(allowed)}, got {value!r}")


def _not_negative(name: str, value: int | None) -> None:
    if value is None:
        return
    if isinstance(value, bool) or not isinstance(value, int) or value < 0:
        raise ValueError(f"{name} must be a whole number of at least 0, got {value!r}")


@dataclass(frozen=True)
class OfferFilters:
    """User filters on job offers; ``None`` leaves a filter out."""

    query: str | None = None
    min_salary: int | None = None
    min_salary_period: str | None = None
    employment_type: str | None = None
    remote_type: str | None = None
    last_n_days: int | None = None

    def __post_init__(self) -> None:
        _one_of("min_salary_period", self.min_salary_period, PERIOD_CODES)
        _one_of("employment_type", self.employment_type, EMPLOYMENT_PHRASES)
        _one_of("remote_type", self.remote_type, REMOTE_CODES)
        _not_negative("min_salary", self.min_salary)
        _not_negative("last_n_days", self.last_n_days)

    @property
    def salary_period(self) -> str:
        """The chosen period; without one, three digits and more are monthly pay."""
        if self.min_salary_period:
            return self.min_salary_period
        return "month" if (self.min_salary or 0) >= 100 else "hour"


@dataclass(frozen=True)
class RunParams:
    """What to extract and how. Exactly one of ``dataset`` and ``start_urls``."""

    dataset: str | None = None
    start_urls: tuple[str, ...] | None = None
    detailed: bool = False
    count_only: bool = False
    filters: OfferFilters = OfferFilters()
    max_entries: int | None = None
    include_personal_data: bool = False
    keep_base_query: bool = False
    transform: Callable[[DataFrame], DataFrame] | None = None
    keep_if: str | None = None
    actor_id: str | None = None
    run_id: str | None = None
    run_url: str | None = None

    def __post_init__(self) -> None:
        if not self.start_urls and not self.dataset:
            raise ValueError("one of dataset or start_urls is needed")
        if self.start_urls and self.dataset:
            raise ValueError("give only one of dataset and start_urls")
        _one_of("dataset", self.dataset, DATASET_KINDS)
        _not_negative("max_entries", self.max_entries)
