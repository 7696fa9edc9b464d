"""Parameters of one quarter close."""

from __future__ import annotations

import calendar
import datetime as dt
from dataclasses import dataclass

# cost/revenue codes, currencies and rates of the close.
NPR_CODES = ("Y103", "Y204", "Y220")
INCURRED_CODES = (
    "Y204", "Z204", "Y220", "Z220", "Y600", "Z600", "Z400", "Y400", "Z303", "Y303",
)
SETTLEMENT_CODES = ("Y100", "Z100", "Y103", "Z103")
NPR_RATE = 0.003
WHOLE_NOMINAL_CURRENCIES = ("TWD",)
WHOLE_UNIT_CURRENCIES = ("TWD", "HUF", "ISK", "JPY", "KRW")
WHOLE_EUR_CURRENCIES = ("HUF", "ISK", "JPY", "KRW")
BASE_CURRENCY = "EUR"
OPENING_EXPOSURE = 10
CLOSING_EXPOSURE = 60
BALANCE_RATE_TYPE = "M"
AVERAGE_RATE_TYPE = "AVG"
LIFE, NON_LIFE = "zivot", "nezivot"


def parse_day_first(text: str) -> dt.date:
    """``31.03.2022`` -> date."""
    return dt.datetime.strptime(text, "%d.%m.%Y").date()


def shift_month_end(day: dt.date, months: int) -> dt.date:
    """Last day of the month lying ``months`` away from the month of ``day``."""
    serial = day.year * 12 + (day.month - 1) + months
    year, month = divmod(serial, 12)
    return dt.date(year, month + 1, calendar.monthrange(year, month + 1)[1])


@dataclass(frozen=True)
class CloseParams:
    """Dates, rates and code lists of one close; pass it, never use globals."""

    closing: dt.date = dt.date(2022, 3, 31)
    opening: dt.date = dt.date(2021, 12, 31)
    plan_year: int = 2022
    npr_rate: float = NPR_RATE
    npr_codes: tuple[str, ...] = NPR_CODES
    incurred_codes: tuple[str, ...] = INCURRED_CODES
    settlement_codes: tuple[str, ...] = SETTLEMENT_CODES
    whole_nominal: tuple[str, ...] = WHOLE_NOMINAL_CURRENCIES
    whole_units: tuple[str, ...] = WHOLE_UNIT_CURRENCIES
    base_currency: str = BASE_CURRENCY
    #: First and last year of the calendar, and the day that stands for an open end.
    calendar_years: tuple[int, int] = (1950, 2099)
    open_end: dt.date = dt.date(9999, 12, 31)

    @classmethod
    def for_closing(cls, closing: dt.date | str, **changes) -> CloseParams:
        """Opening date and plan year follow from a quarter-end closing date."""
        if isinstance(closing, str):
            closing = parse_day_first(closing)
        opening = shift_month_end(closing, -3)
        return cls(closing=closing, opening=opening, plan_year=closing.year, **changes)

    @property
    def past_label(self) -> str:
        return f"till 31.12.{self.plan_year - 1}"

    @property
    def future_label(self) -> str:
        return f"from 1.1.{self.plan_year + 1}"
