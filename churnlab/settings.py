"""Run settings: the explicit dates that make every result repeatable."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """Parameters shared by the models.

    as_of       open end of subscriptions that have not ended (replaces the
                reference's current_date(), so output does not change daily).
    cap         last month the economics mart may reach (data end); None means
                no cap, as in the prototype view.
    week_start  'sunday' (warehouse models) or 'monday' (prototype views).
    churn_benchmark  monthly churn rate the churn metric is flagged against.
    """

    as_of: dt.date
    cap: dt.date | None = None
    week_start: str = "sunday"
    churn_benchmark: float = 0.05

    def with_(self, **changes) -> "Settings":
        values = {**self.__dict__, **changes}
        return Settings(**values)


# Fixed values for the driver's test tables (see FIXTURES.md section 2):
# orders run to 2001-08-01, so a cap at 2001-06-01 cuts some series and
# leaves some starts after the cap with no month at all.
FIXTURE_SETTINGS = Settings(
    as_of=dt.date(2001, 12, 31),
    cap=dt.date(2001, 6, 1),
    week_start="sunday",
)
