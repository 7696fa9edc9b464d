"""Date expressions and period buckets."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from closebook.params import CloseParams, shift_month_end


def from_int(ymd: Column) -> Column:
    """Integer ``YYYYMMDD`` -> DATE by arithmetic; an impossible date is an error."""
    whole = ymd.cast("int")
    return F.make_date(
        (whole / 10000).cast("int"),
        (whole / 100).cast("int") % 100,
        whole % 100,
    )


def from_dotted(text: Column) -> Column:
    """Text ``DD.MM.YYYY`` -> DATE."""
    return F.to_date(text, "dd.MM.yyyy")


def to_int(day: Column) -> Column:
    """DATE -> integer ``YYYYMMDD``."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def align_month_end(day: Column) -> Column:
    """A month end stays; any other day goes back to the previous month end."""
    return F.date_sub(F.trunc(F.date_add(day, 1), "MM"), 1)


def shift_month_ends(day: Column, months: int) -> Column:
    return F.last_day(F.add_months(day, months))


# Buckets compare the raw integer date with the month ends of the plan year.
# A day belongs to the period its aligned month end lies in, so a period starts
# at the month end of its first month: the first quarter runs from 31 January
# to 29 April. Integer ranges are cheap to repeat in a pushed-down filter and
# reach the file scan.


def _as_int(day: dt.date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def _starts(params: CloseParams) -> list[int]:
    """First days of the four quarters and of the time after."""
    opening_year_end = dt.date(params.plan_year - 1, 12, 31)
    return [_as_int(shift_month_end(opening_year_end, m)) for m in (1, 4, 7, 10, 13)]


def in_past_or_first_quarter(ymd: Column, periods: Iterable[str], params: CloseParams) -> Column:
    """Whether a day lies in the past, in the first quarter or in either, as one integer range."""
    first, second, *_ = _starts(params)
    wanted = set(periods)
    if not wanted or wanted - {params.past_label, "Q1"}:
        raise ValueError(f"no single range: {sorted(wanted)}")
    until = ymd < (second if "Q1" in wanted else first)
    return until if params.past_label in wanted else (ymd >= first) & until


def _quarters(ymd: Column, params: CloseParams, before: Column, after: Column) -> Column:
    starts = _starts(params)
    label = F.when(ymd < starts[0], before)
    for number, start in enumerate(starts[1:], 1):
        label = label.when(ymd < start, F.lit(f"Q{number}"))
    return label.when(ymd >= starts[-1], after)


def bucket_by_window(ymd: Column, params: CloseParams) -> Column:
    """Quarter inside the plan year, one label for all before and one for all after."""
    return _quarters(ymd, params, F.lit(params.past_label), F.lit(params.future_label))


def bucket_by_year(ymd: Column, params: CloseParams) -> Column:
    """Quarter inside the plan year, otherwise the year of the aligned month end."""
    in_previous_year = (ymd % 10000 < 131).cast("int")
    year = ((ymd / 10000).cast("int") - in_previous_year).cast("string")
    return _quarters(ymd, params, year, year)


def on_or_before(ymd: Column, day: dt.date) -> Column:
    return ymd <= _as_int(day)


def is_day(day: Column, wanted: dt.date) -> Column:
    return F.coalesce(day == F.lit(wanted), F.lit(False))
