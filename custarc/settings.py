"""Parameters shared by the models."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime


# Switches between what is kept compatible ('reference') and another reading.
_SWITCHES = {"mrr_mode": "corrected", "subscription_match": "as_of", "cohort": "first_month", "users": "one_per_email"}


@dataclass(frozen=True)
class Settings:
    """One immutable set of parameters per run.

    spine_start, spine_end   calendar bounds, end exclusive
    horizon                  last day an open annual subscription is expanded to
    max_months               most months one annual row is expanded into
    weekend_days             day numbers (Sunday = 0) flagged as weekend
    mrr_mode                 'reference' repeats a group's MRR once per detail row of the
                             group and gives groups with a NULL key 0;
                             'corrected' reports each group's MRR once
    renewal_first            look for 'renewal' before 'new' (a substring of it) when a
                             missing transaction type is read from the description
    subscription_match       'reference' gives a payment every version of its user whose period
                             starts on its day; 'as_of' the latest version of its user that
                             started by then, if it still holds that day
    cohort                   'reference' groups retention by the row's own month and the rank of
                             its month number, whatever the year; 'first_month' by the month of
                             the subscription's first row and the months since then
    users                    'reference' keeps all user rows, so a shared e-mail repeats facts;
                             'one_per_email' makes rows that share an e-mail or an id one user
    run_ts                   value of loaded_at; the time of the query when None
    """

    spine_start: date = date(2025, 1, 1)
    spine_end: date = date(2026, 1, 1)
    horizon: date = date(2025, 12, 31)
    max_months: int = 12
    weekend_days: tuple[int, ...] = (1, 7)
    mrr_mode: str = "reference"
    renewal_first: bool = False
    subscription_match: str = "reference"
    cohort: str = "reference"
    users: str = "reference"
    run_ts: datetime | None = None

    def __post_init__(self) -> None:
        for name, other in _SWITCHES.items():
            if (value := getattr(self, name)) not in ("reference", other):
                raise ValueError(f"{name} must be 'reference' or {other!r}, not {value!r}")
        if self.spine_end <= self.spine_start:
            raise ValueError("spine_end must be after spine_start")
        if self.max_months < 1:
            raise ValueError("max_months must be at least 1")
