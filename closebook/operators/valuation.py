"""FX conversion, discount curves and present values."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closebook.functions import dates
from closebook.functions.money import (
    divide,
    half_even_for,
    half_even_where,
    member,
    zero_if_null,
)
from closebook.operators import calendar
from closebook.operators.grouping import union_books
from closebook.operators.lookups import left_lookup
from closebook.params import (
    AVERAGE_RATE_TYPE,
    BALANCE_RATE_TYPE,
    CLOSING_EXPOSURE,
    OPENING_EXPOSURE,
    CloseParams,
)

RATE = "EXCHANGE_RATE"
CURRENCY = "I17ESTCURR"


def rate_set(rates: DataFrame, kind: str | None = None, base: str | None = None) -> DataFrame:
    """Currency and rate of one rate type; optionally with the base currency at 1.

    The base row is appended, whatever the table already holds.
    """
    if kind is not None:
        rates = rates.filter(F.col("type") == kind)
    rates = rates.select("FROM_CURRENCY", RATE)
    if base is not None:
        row = rates.sparkSession.sql(
            f"SELECT '{base}' AS FROM_CURRENCY, CAST(1 AS DOUBLE) AS {RATE}"
        )
        rates = rates.unionByName(row)
    return rates


def average_rates(rates: DataFrame, params: CloseParams) -> DataFrame:
    return rate_set(rates, AVERAGE_RATE_TYPE, params.base_currency)


def balance_rates(rates: DataFrame) -> DataFrame:
    return rate_set(rates, BALANCE_RATE_TYPE)


def with_rate(df: DataFrame, rates: DataFrame, force_base: str | None = None) -> DataFrame:
    """Attach the rate of the row's currency; optionally force the base to 1."""
    dim = rates.select(F.col("FROM_CURRENCY").alias(CURRENCY), RATE)
    rated = left_lookup(df, dim, [CURRENCY])
    if force_base is None:
        return rated
    forced = F.when(F.col(CURRENCY) == force_base, F.lit(1.0)).otherwise(F.col(RATE))
    return rated.withColumn(RATE, forced)


def with_rate_by(
    df: DataFrame, sets: Mapping[str, DataFrame], tag: str, force_base: str
) -> DataFrame:
    """Attach rates from the set that the row's ``tag`` names, the base currency at 1."""
    parts = [
        rates.select(F.col("FROM_CURRENCY").alias(CURRENCY), RATE, F.lit(name).alias(tag))
        for name, rates in sets.items()
    ]
    dim = parts[0]
    for part in parts[1:]:
        dim = dim.unionByName(part)
    forced = F.when(F.col(CURRENCY) == force_base, F.lit(1.0)).otherwise(F.col(RATE))
    return left_lookup(df, dim, [CURRENCY, tag]).withColumn(RATE, forced)


def with_rate_by_exposure(
    df: DataFrame, opening: DataFrame, closing: DataFrame, params: CloseParams
) -> DataFrame:
    """Opening rates for exposure 10, closing balance rates for exposure 60.

    One join on (currency, exposure) instead of splitting the rows; any other
    exposure is dropped.
    """
    return rated_by_exposure(df.filter(has_rate_set(F.col("I17EXPCHANGE"))), opening, closing, params)


def has_rate_set(exposure: Column) -> Column:
    return F.coalesce(exposure.isin(OPENING_EXPOSURE, CLOSING_EXPOSURE), F.lit(False))


def rated_by_exposure(
    df: DataFrame, opening: DataFrame, closing: DataFrame, params: CloseParams
) -> DataFrame:
    """The same with the rows of other exposures, whose rate means nothing."""
    both = (
        rate_set(opening)
        .withColumn("I17EXPCHANGE", F.lit(OPENING_EXPOSURE))
        .unionByName(
            balance_rates(closing).withColumn("I17EXPCHANGE", F.lit(CLOSING_EXPOSURE))
        )
        .withColumnRenamed("FROM_CURRENCY", CURRENCY)
    )
    rated = left_lookup(df, both, [CURRENCY, "I17EXPCHANGE"])
    forced = F.when(F.col(CURRENCY) == params.base_currency, F.lit(1.0))
    return rated.withColumn(RATE, forced.otherwise(F.col(RATE)))


def curve_date(curve: DataFrame) -> Column:
    """Curve files carry the date as an integer or as dotted text."""
    kind = curve.schema["I17DISCDATE"].dataType.typeName()
    column = F.col("I17DISCDATE")
    if kind == "date":
        return column
    return dates.from_dotted(column) if kind == "string" else dates.from_int(column)


def stack_curves(curves: Mapping[str, DataFrame]) -> DataFrame:
    """All curves below each other, named in ``curve``, dates as DATE."""
    return union_books(
        [
            curve.select(
                curve_date(curve).alias("date_adjusted"),
                CURRENCY,
                F.lit(name).alias("curve"),
                "I17DISCFACT",
            )
            for name, curve in curves.items()
        ]
    )


def widen_curves(stacked: DataFrame, names: Sequence[str]) -> DataFrame:
    """Stacked curves -> one row per (date, currency) with a ``factor_<name>`` each.

    A curve that holds two rows for one key would silently multiply cash
    flows later; it stops the job here.
    """
    columns = []
    for name in names:
        here = F.when(F.col("curve") == name, F.col("I17DISCFACT"))
        twice = F.raise_error(F.lit(f"curve {name}: duplicate date and currency"))
        columns.append(
            F.when(F.count(here) > 1, twice.cast("double"))
            .otherwise(F.max(here))
            .alias(f"factor_{name}")
        )
    return stacked.groupBy("date_adjusted", CURRENCY).agg(*columns)


def wide_curves(curves: Mapping[str, DataFrame]) -> DataFrame:
    """N curve files -> one wide table, joined once instead of N times."""
    return widen_curves(stack_curves(curves), list(curves))


def with_aligned_date(df: DataFrame, params: CloseParams) -> DataFrame:
    """``date_adjusted``: the settlement date as a month end."""
    return calendar.look_up(df, "I17SETTLEMDATE", {"date_adjusted": calendar.MONTH_END}, params)


def with_buckets(df: DataFrame, params: CloseParams, by: str = "window") -> DataFrame:
    """``settlement`` and ``incurred`` period labels."""
    label = _label(by)
    df = calendar.look_up(df, "I17SETTLEMDATE", {"settlement": label}, params)
    return calendar.look_up(df, "I17INCURREDDATE", {"incurred": label}, params)


def with_periods(df: DataFrame, params: CloseParams, by: str = "window") -> DataFrame:
    """Month end and both labels: the settlement date is looked up once for two of them."""
    label = _label(by)
    both = {"date_adjusted": calendar.MONTH_END, "settlement": label}
    df = calendar.look_up(df, "I17SETTLEMDATE", both, params)
    return calendar.look_up(df, "I17INCURREDDATE", {"incurred": label}, params)


def _label(by: str) -> str:
    return calendar.BY_WINDOW if by == "window" else calendar.BY_YEAR


def with_factors(
    df: DataFrame, curves: DataFrame, names: Sequence[str], calculation_date: dt.date
) -> DataFrame:
    """Attach the factors; cash flows at the calculation date have factor 1."""
    dim = curves.select("date_adjusted", CURRENCY, *[f"factor_{n}" for n in names])
    joined = left_lookup(df, dim, ["date_adjusted", CURRENCY])
    at_date = dates.is_day(F.col("date_adjusted"), calculation_date)
    return joined.withColumns(
        {
            f"factor_{n}": F.when(at_date, F.lit(1.0)).otherwise(F.col(f"factor_{n}"))
            for n in names
        }
    )


def present_values(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Nominal and discount (present value less nominal), both currencies.

    A missing rate or factor leaves the value null, so that sums skip it.
    """
    amount, rate = F.col("I17ESTAMOUNT"), F.col(RATE)
    valued = df.withColumns(
        {"nominal_original_CCY": amount, "nominal": divide(amount, rate)}
    )
    original, nominal = F.col("nominal_original_CCY"), F.col("nominal")
    columns = {}
    for name in names:
        cash = F.col(f"factor_{name}") * original
        columns[f"discount_{name}"] = divide(cash, rate) - nominal
        columns[f"discount_{name}_original_CCY"] = cash - original
    return valued.withColumns(columns)


def rounded_present_values(
    df: DataFrame, names: Sequence[str], params: CloseParams
) -> DataFrame:
    """The same with whole-unit currencies and missing values counted as zero.

    The order is the rule: EUR values come from unrounded amounts, rounding of
    the discounted amount in original currency comes after the EUR value is
    taken, and a missing factor means a present value of zero.
    """
    amount, rate, currency = F.col("I17ESTAMOUNT"), F.col(RATE), F.col(CURRENCY)
    # One step for each value that two others read: it is worked out once, and the generated
    # code stays small enough for the JVM to compile.
    df = df.withColumns(
        {
            "_whole_nominal": member(currency, params.whole_nominal),
            "_whole_units": member(currency, params.whole_units),
        }
    )
    whole_nominal, whole_units = F.col("_whole_nominal"), F.col("_whole_units")
    df = df.withColumns(
        {
            "nominal": zero_if_null(divide(amount, rate)),
            "nominal_original_CCY": zero_if_null(half_even_where(whole_nominal, amount)),
        }
    )
    original, nominal = F.col("nominal_original_CCY"), F.col("nominal")
    df = df.withColumns({f"_flow_{n}": zero_if_null(F.col(f"factor_{n}") * original) for n in names})
    df = df.withColumns({f"_euro_{n}": zero_if_null(divide(F.col(f"_flow_{n}"), rate)) for n in names})
    columns = {}
    for name in names:
        flow, euro = F.col(f"_flow_{name}"), F.col(f"_euro_{name}")
        columns[f"discount_{name}"] = half_even_where(whole_nominal, euro) - nominal
        columns[f"discount_{name}_original_CCY"] = half_even_where(whole_units, flow) - original
    steps = [f"_{kind}_{n}" for n in names for kind in ("flow", "euro")]
    return df.withColumns(columns).drop("_whole_nominal", "_whole_units", *steps)


def round_currencies(
    df: DataFrame, currencies: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Whole units for the named columns in the given currencies."""
    return df.withColumns(
        {c: half_even_for(F.col(CURRENCY), currencies, F.col(c)) for c in columns}
    )


def npr_columns(df: DataFrame, names: Sequence[str], params: CloseParams) -> DataFrame:
    """``npr_<name>`` per curve; 0 for codes the charge does not apply to."""
    charged = member(F.col("I17COSTREVENUE"), params.npr_codes)
    return df.withColumns(
        {
            f"npr_{n}": F.when(
                charged,
                (F.col("nominal") + F.col(f"discount_{n}")) * -1.0 * params.npr_rate,
            ).otherwise(F.lit(0.0))
            for n in names
        }
    )


def npr_amount(params: CloseParams, discount: str = "discount") -> Column:
    """Charge on nominal plus discount; null for codes without a charge."""
    value = (F.col("nominal") + F.col(discount)) * params.npr_rate * -1.0
    return F.when(member(F.col("I17COSTREVENUE"), params.npr_codes), value)


def shift_correction(
    df: DataFrame, pairs: Mapping[str, str], first_quarter: str = "Q1"
) -> DataFrame:
    """First-quarter settlements take the unshifted curve's discounts."""
    early = F.coalesce(F.col("settlement") == first_quarter, F.lit(False))
    columns = {}
    for shifted, plain in pairs.items():
        for suffix in ("", "_original_CCY"):
            target = f"discount_{shifted}{suffix}"
            columns[target] = F.when(early, F.col(f"discount_{plain}{suffix}")).otherwise(
                F.col(target)
            )
    return df.withColumns(columns)
