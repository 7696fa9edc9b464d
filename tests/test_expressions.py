"""Scalar expressions against plain Python statements of the same rules."""

from __future__ import annotations

import calendar
import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from closebook.functions import dates, ids, money
from closebook.params import CloseParams, parse_day_first, shift_month_end

IDS = [
    "CZR_ACP_PRI_P500_2020_NO_320",
    "CZR_ACP_LRH_L510_2021_NO_10260/1",
    "CZR_ACP_LRI_P501_2022_ON_7/12",
    "CZR_ACP_PRH_2020_ON_320",
    "CZR_ACP_PRI_P500_2020_NO_320_X",
    "CZR_ACP_LRI",
    "CZR_ACP_LRI_P1",
]


def _cut(parts, a, b=None):
    return "_".join(parts[a:b])


def test_contract_forms(frame):
    df = frame([(i,) for i in IDS], "ref string")
    made = df.select("ref", *[ids.contract(F.col("ref"), n).alias(n) for n in ids.CONTRACT_FORMS])
    for row in made.collect():
        whole, stem = row.ref.split("_"), row.ref.split("/")[0].split("_")
        assert row.segment == _cut(stem, 2, 3) + "_" + _cut(stem, 4, 7)
        assert row.tail3 == _cut(stem, -3)
        assert row.tail2 == _cut(stem, -2)
        assert row.segment_tail == stem[2] + "_" + _cut(stem, -3)
        assert row.from_segment == _cut(stem, 2)
        assert row.portfolio == _cut(whole, 2, 6)


def test_segment_life_and_short_ids(frame):
    df = frame([(i,) for i in [*IDS, "CZR_ACP", None]], "ref string")
    ref = F.col("ref")
    made = df.select(
        "ref", ids.segment(ref).alias("seg"), ids.life_flag(ref).alias("life"),
        ids.contract(ref, "segment_tail").alias("key"), ids.contract(ref, "segment").alias("first"),
    )
    found = {r.ref: r for r in made.collect()}
    assert found[IDS[1]].seg == "RH" and found[IDS[1]].life == "zivot"
    assert found[IDS[0]].seg == "RI" and found[IDS[0]].life == "nezivot"
    assert found["CZR_ACP"].seg is None and found["CZR_ACP"].key is None
    assert found["CZR_ACP"].first == "_"
    assert found[None].first is None
    marker = frame([("2020_NO_320",), ("2020",)], "c string")
    assert [r[0] for r in marker.select(ids.onerous_marker(F.col("c"))).collect()] == ["NO", None]


def _month_end_rule(day: dt.date) -> dt.date:
    if (day + dt.timedelta(days=1)).day == 1:
        return day
    return day.replace(day=1) - dt.timedelta(days=1)


@pytest.fixture(scope="module")
def all_days(spark):
    first = dt.date(2019, 12, 1)
    days = [first + dt.timedelta(days=i) for i in range(5 * 366)]
    return spark.createDataFrame(
        [(d, d.year * 10000 + d.month * 100 + d.day) for d in days], "day date, ymd int"
    ).cache()


def test_month_end_goes_back(all_days):
    made = all_days.select(
        "day", "ymd",
        dates.from_int(F.col("ymd")).alias("parsed"),
        dates.align_month_end(F.col("day")).alias("aligned"),
        dates.to_int(F.col("day")).alias("back"),
    )
    for r in made.collect():
        assert r.parsed == r.day and r.back == r.ymd
        assert r.aligned == _month_end_rule(r.day)
    again = made.select((dates.align_month_end(F.col("aligned")) == F.col("aligned")).alias("same"))
    assert again.filter("not same").count() == 0


def test_buckets_follow_aligned_month_end(all_days):
    params = CloseParams()
    made = all_days.select(
        "day",
        dates.bucket_by_window(F.col("ymd"), params).alias("window"),
        dates.bucket_by_year(F.col("ymd"), params).alias("year"),
    )
    seen = set()
    for r in made.collect():
        aligned = _month_end_rule(r.day)
        quarter = f"Q{(aligned.month + 2) // 3}"
        inside = aligned.year == 2022
        outside = "till 31.12.2021" if aligned.year < 2022 else "from 1.1.2023"
        assert r.window == (quarter if inside else outside), r.day
        assert r.year == (quarter if inside else str(aligned.year)), r.day
        seen.add(r.window)
    assert len(seen) == 6


def test_dates_null_and_impossible(frame):
    df = frame([(None,)], "ymd int")
    row = df.select(
        dates.bucket_by_window(F.col("ymd"), CloseParams()), dates.from_int(F.col("ymd"))
    ).first()
    assert tuple(row) == (None, None)
    with pytest.raises(Exception, match="(?i)date|invalid"):
        frame([(20220230,)], "ymd int").select(dates.from_int(F.col("ymd"))).collect()


def test_dotted_dates_and_shift(frame):
    df = frame([("31.03.2022",), ("29.02.2020",)], "t string")
    made = df.select(
        dates.from_dotted(F.col("t")), dates.shift_month_ends(dates.from_dotted(F.col("t")), -3)
    )
    assert [tuple(r) for r in made.collect()] == [
        (dt.date(2022, 3, 31), dt.date(2021, 12, 31)),
        (dt.date(2020, 2, 29), dt.date(2019, 11, 30)),
    ]


def test_params():
    params = CloseParams.for_closing("31.03.2022")
    assert params == CloseParams()
    assert params.opening == dt.date(2021, 12, 31)
    assert (params.past_label, params.future_label) == ("till 31.12.2021", "from 1.1.2023")
    assert parse_day_first("29.02.2020") == dt.date(2020, 2, 29)
    for months in range(-30, 30):
        day = shift_month_end(dt.date(2021, 5, 17), months)
        assert day.day == calendar.monthrange(day.year, day.month)[1]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-1e9, 1e9), min_size=50, max_size=200))
def test_half_even_is_python_round(spark, values):
    values += [0.5, 1.5, 2.5, -0.5, -2.5, 0.49999999999999994, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for r in df.select("x", money.half_even(F.col("x")).alias("r")).collect():
        assert r.r == (None if r.x is None else round(r.x))


def test_amount_texts(frame):
    df = frame([("123.45-",), ("123.45",), ("0.00-",), (None,)], "t string")
    assert [r[0] for r in df.select(money.trailing_minus(F.col("t"))).collect()] == [-123.45, 123.45, 0.0, None]
    df = frame([("1234,5",), ("-0,25",), ("",), (None,), ("3,02E8",)], "t string")
    assert [r[0] for r in df.select(money.decimal_comma(F.col("t"))).collect()] == [1234.5, -0.25, None, None, 302000000.0]
    df = frame([(302749820.77,), (-0.5,), (100.0,), (0.0,), (None,)], "x double")
    assert [r[0] for r in df.select(money.to_decimal_comma(F.col("x"))).collect()] == [
        "302749820,77", "-0,5", "100", "0", None,
    ]


def test_null_rules_of_amounts(frame):
    df = frame([(1.0, None, 0.0), (float("nan"), 2.0, 4.0)], "a double, b double, c double")
    made = df.select(
        money.row_total(F.col("b"), F.col("c")), money.divide(F.lit(1.0), F.col("c")),
        money.null_if_nan(F.col("a")), money.member(F.col("b").cast("string"), ["2.0"]),
    )
    assert [tuple(r) for r in made.collect()] == [(0.0, None, 1.0, False), (6.0, 0.25, None, True)]
